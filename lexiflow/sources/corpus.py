"""Sources and sinks of the classification flows: labelled folders, TF-IDF tables,
fold files, vocabulary files and metric reports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_STOP_WORDS, sanitize_text
from ..operators.ranking import range_rank, running_sum
from ..session import stored


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "input") -> DataFrame:
    """Fail early, before any job, when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; has {df.columns}")
    return df


def read_labelled_directory(spark: SparkSession, base: str, clean: bool = True,
                            stop_words: Sequence[str] = DEFAULT_STOP_WORDS, only_alpha: bool = True,
                            sep: str = " ", encoding: str = "UTF-8") -> DataFrame:
    """``base/<class>/<file>`` → (doc_id, text, class). One sub-folder is one class, one
    file one document; files directly under ``base`` are not read. ``doc_id`` is the
    rank of the path (paths alone are ranked, by range partitions); with ``clean`` the text is
    cleaned on load (kept words, each followed by a space)."""
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
           .load(f"{base.rstrip('/')}/*/*"))
    docs = raw.select(
        F.col("path"),
        F.decode(F.col("content"), encoding).alias("text"),
        F.element_at(F.split(F.col("path"), "/"), -2).alias("class"),
    )
    places = range_rank(docs.select("path"), "path", "doc_id").withColumnRenamed("path", "_path")
    text = sanitize_text(F.col("text"), stop_words, only_alpha, sep) if clean else F.col("text")
    return docs.join(places, F.col("path") == F.col("_path")).select("doc_id", text.alias("text"), "class")


# ------------------------------------------------------------------ tables
def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Parquet sink (TF-IDF table, fold snapshot, predictions)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


MANIFEST = "_manifest.json"


def input_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of all files under the paths, sorted."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def fingerprint(spark: SparkSession, params: object = None, inputs: Sequence[str] = ()) -> str:
    """Digest of the parameters (anything JSON can write; dataclasses as dictionaries) and the input files."""
    plain = asdict(params) if is_dataclass(params) else params
    return hashlib.sha256(json.dumps([plain, input_files(spark, inputs)], sort_keys=True, default=str).encode()).hexdigest()


def _write_file(spark: SparkSession, path: str, text: str) -> None:
    """The whole file or none: written beside its place, then renamed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}")
    fs = place.getFileSystem(conf)
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(place, False)
    if not fs.rename(beside, place):
        raise OSError(f"could not write {path}")


def _manifest(spark: SparkSession, path: str) -> str | None:
    file = f"{path.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, file):
        return None
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["fingerprint"]
    finally:
        stream.close()


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False,
                  partition_by: Sequence[str] = (), params: object = None, inputs: Sequence[str] = ()) -> DataFrame:
    """Reuse a stored artefact that was built from the same parameters and input files, else build it,
    write it and read it back. A manifest with their fingerprint is written after the data, so one
    whose write did not finish has none and is built again."""
    own = fingerprint(spark, params, inputs)
    if rebuild or _manifest(spark, path) != own:
        write_table(build(), path, partition_by=partition_by)
        _write_file(spark, f"{path.rstrip('/')}/{MANIFEST}", json.dumps({"fingerprint": own}))
    return spark.read.parquet(path)


# ------------------------------------------------------------------ folds
def read_folds_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested fold file ``{fold: {"text": {idx: text}, "class": {idx: class}}}`` →
    (doc_id, text, class, fold), in any layout of white space and order of the two sections. ``path`` is one
    file, or a folder whose files put together in the order of their names are the document.

    The document is read by as many tasks as it has byte ranges: Spark's text
    source cuts it at quotes, so its pieces lie inside and outside of strings in turn (a piece
    that ends with an odd number of backslashes is cut at an escaped quote). What a piece is follows
    from what lies before it, as running sums: quotes give the number of the string it belongs to,
    braces its depth, keys of depth two the section. A sum runs inside a byte range and adds the totals of
    the ranges before."""
    raw = spark.read.option("lineSep", '"').text(path).select(
        F.col("_metadata.file_name").alias("file"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))
    raw = stored(raw.withColumn("part", F.concat_ws("/", "file", "start")), "fold-pieces")
    ends = raw.groupBy("file").agg(F.max(F.struct("start", "at")).alias("e"))  # no quote behind a file's last piece
    ends = ends.select(F.col("file").alias("e_file"), F.col("e.start").alias("e_start"), F.col("e.at").alias("e_at"))
    # pieces are not shuffled for this, nor read where only the sums are asked for: a row per file is sent to them
    raw = raw.withColumn("escaped", F.length(F.regexp_extract("piece", r"\\*$", 0)) % 2).join(
        F.broadcast(ends), (F.col("file") == F.col("e_file")) & (F.col("start") == F.col("e_start")) & (F.col("at") == F.col("e_at")), "left")
    raw = raw.select("part", "at", "piece", F.when(F.col("e_at").isNull(), 1 - F.col("escaped")).otherwise(0).alias("ends"))
    quotes = running_sum(raw, "ends", "before")
    quotes = quotes.withColumn("inside", F.col("before") % 2 == 1).withColumn("string", F.floor(F.col("before") / 2))
    # strings put together from their pieces; what stands outside follows a string of the number before
    parts = F.array_sort(F.collect_list(F.struct("part", "at", "piece")))
    whole = lambda between: F.array_join(F.transform(parts, lambda x: x["piece"]), between)
    text = quotes.where("inside").groupBy("string").agg(whole('"').alias("raw"))
    count = lambda c: F.length("piece") - F.length(F.replace("piece", F.lit(c)))
    outside = quotes.where("NOT inside").groupBy("string").agg(F.min(F.struct("part", "at")).alias("p"), whole("").alias("piece"))
    outside = outside.select("p.part", "p.at", "piece", "string", (count("{") - count("}")).alias("nest"))
    outside = running_sum(stored(outside, "fold-outside"), "nest", "depth")
    # the piece behind string n has the number n + 1; its depth so far is that of the string
    behind = outside.select((F.col("string") - 1).alias("string"), "part", "at", "depth", F.col("piece").rlike(r"^\s*:").alias("is_key"),
                            F.regexp_extract("piece", r"^\s*:\s*([^\s,{}]+)", 1).alias("literal"))
    value = F.from_json(F.concat(F.lit('["'), "raw", F.lit('"]')), "array<string>")[0]
    strings = text.join(behind, "string").select("string", "part", "at", "depth", "is_key", "literal", value.alias("value"))
    strings = stored(strings, "fold-strings")
    # only keys open sections, and only keys are asked for theirs: the values stay where they are
    keys = strings.where("is_key").withColumn("section", (F.col("depth") == 2).cast("int"))
    keys = stored(running_sum(keys, "section", "sections"), "fold-keys")
    names = keys.where("depth = 2").select((F.col("sections") + 1).alias("n_section"), F.col("value").alias("name"))
    # the key of a fold stands before its first section; sections up to the next fold are its own
    folds = keys.where("depth = 1").select(F.col("sections").alias("first"), F.col("value").alias("fold"))
    until = folds.withColumn("upto", F.lead("first").over(Window.orderBy("first")))  # one row per fold
    last = names.agg(F.max("n_section")).scalar()
    of_fold = until.select("fold", F.explode(F.sequence(F.col("first") + 1, F.greatest(F.coalesce("upto", last), F.col("first") + 1))).alias("n_section"))
    sections = names.join(of_fold, "n_section")
    entries = keys.where("depth = 3").select((F.col("string") + 1).alias("v_string"), F.col("sections").alias("n_section"), F.col("value").alias("idx"), "literal")
    told = strings.select(F.col("string").alias("v_string"), F.col("value").alias("v"))
    entries = entries.join(told, "v_string", "left").join(sections, "n_section").select(
        "fold", "name", "idx", F.when(F.col("literal") == "", F.col("v")).when(F.col("literal") != "null", F.col("literal")).alias("v"))
    texts = entries.where("name = 'text'").select("fold", "idx", F.col("v").alias("text"))
    classes = entries.where("name = 'class'").select(F.col("fold").alias("c_fold"), F.col("idx").alias("c_idx"), F.col("v").alias("class"))
    rows = texts.join(classes, (F.col("fold") == F.col("c_fold")) & (F.col("idx") == F.col("c_idx")), "left")
    return rows.select(F.col("idx").cast("bigint").alias("doc_id"), "text", "class", F.col("fold").cast("int").alias("fold"))


def write_folds_json(folds: DataFrame, path: str) -> None:
    """(doc_id, text, class, fold) as the nested document that ``read_folds_json`` reads: a folder of text files
    that are the document when put together in the order of their names. Rows are dealt by ranges of
    (fold, section, doc_id), so the largest fold is written by many tasks."""
    literal = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1), F.lit("null"))
    first = folds.groupBy(F.col("fold").alias("f_fold")).agg(F.min("doc_id").alias("f_id"))
    lowest = folds.select(F.min("fold")).scalar()
    entry = F.concat(F.when(F.col("doc_id") == F.col("f_id"), "").otherwise(", "), F.lit('"'), F.col("doc_id").cast("string"), F.lit('": '))
    rows = folds.select("fold", "doc_id", "text", "class").join(first, F.col("fold") == F.col("f_fold"))
    lines = rows.select("fold", F.explode(F.array(*(F.struct(F.lit(i).alias("section"), F.lit(1).alias("kind"), "doc_id", F.concat(
        entry, literal(c)).alias("line")) for i, c in enumerate(("text", "class"))))).alias("x")).select("fold", "x.*")
    none = F.lit(None).cast(folds.schema["doc_id"].dataType)
    start = F.concat(F.when(F.col("f_fold") == lowest, "{").otherwise("}}, "), F.lit('"'), F.col("f_fold").cast("string"), F.lit('": {"text": {'))
    heads = first.select(F.col("f_fold").alias("fold"), F.explode(F.array(
        F.struct(F.lit(0).alias("section"), F.lit(0).alias("kind"), none.alias("doc_id"), start.alias("line")),
        F.struct(F.lit(1).alias("section"), F.lit(0).alias("kind"), none.alias("doc_id"), F.lit('}, "class": {').alias("line")))).alias("x")).select("fold", "x.*")
    end = folds.agg(F.max("fold").alias("fold")).select("fold", F.lit(2).alias("section"), F.lit(0).alias("kind"), none.alias("doc_id"),
                                                        F.when(F.col("fold").isNull(), "{}").otherwise("}}}").alias("line"))
    order = ["fold", "section", "kind", "doc_id"]
    (lines.unionByName(heads).unionByName(end).repartitionByRange(*order).sortWithinPartitions(*order).select("line")
     .write.mode("overwrite").text(path))


def write_folds(folds: DataFrame, path: str) -> None:
    """(doc_id, text, class, fold) as JSON lines, one folder per fold."""
    folds.write.mode("overwrite").partitionBy("fold").json(path)


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, text string, class string, fold int").json(path)


def write_fold_csv(split: DataFrame, path: str) -> None:
    """Train/test CSV per fold, sorted by id: ``split`` from ``train_test_split`` joined
    with the text. Folders fold=<i>/split=<train|test>, each written by as many tasks as its
    rows need."""
    (split.repartitionByRange("fold", "split", "doc_id").sortWithinPartitions("fold", "split", "doc_id")
     .write.mode("overwrite").partitionBy("fold", "split").option("header", True).csv(path))


# ------------------------------------------------------------------ vocabulary files
def read_vocabulary(spark: SparkSession, path: str, held: DataFrame | None = None) -> DataFrame:
    """One term per line, stripped; appended to terms already held (set union)."""
    terms = spark.read.text(path).select(F.trim("value").alias("term"))
    return terms if held is None else held.select("term").unionByName(terms).distinct()


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.select("term").write.mode("overwrite").text(path)


# ------------------------------------------------------------------ reports
def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """Per-class / average metrics as CSV with a header (small: one row per class)."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
