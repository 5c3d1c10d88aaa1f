"""Round-trips of the sources and sinks on temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lexiflow.sources import corpus as S


def test_labelled_directory(spark, tmp_dir):
    for cls, files in {"alpha": ["kedi köpek", "a1 kuş"], "beta": ["deniz ve balık"]}.items():
        os.makedirs(f"{tmp_dir}/{cls}")
        for i, text in enumerate(files):
            with open(f"{tmp_dir}/{cls}/f{i}.txt", "w", encoding="utf-8") as fh:
                fh.write(text)
    with open(f"{tmp_dir}/root_file.txt", "w") as fh:
        fh.write("not a document")
    docs = S.read_labelled_directory(spark, tmp_dir).orderBy("doc_id").collect()
    assert [(r.doc_id, r["class"], r.text) for r in docs] == [
        (0, "alpha", "kedi köpek "), (1, "alpha", "kuş "), (2, "beta", "deniz balık ")]


def test_folds_json_reference_layout(spark, tmp_dir):
    doc = {"0": {"text": {"3": "x y ", "5": "z "}, "class": {"3": "a", "5": "b"}},
           "1": {"text": {"4": "w "}, "class": {"4": "a"}}}
    path = f"{tmp_dir}/folds.json"
    with open(path, "w") as fh:
        json.dump(doc, fh)
    rows = sorted((r.doc_id, r.text, r["class"], r.fold) for r in S.read_folds_json(spark, path).collect())
    assert rows == [(3, "x y ", "a", 0), (4, "w ", "a", 1), (5, "z ", "b", 0)]


def test_folds_round_trip(spark, tmp_dir):
    f = spark.createDataFrame([(1, "t1", "a", 0), (2, "t2", "b", 1)], "doc_id long, text string, class string, fold int")
    S.write_folds(f, f"{tmp_dir}/folds")
    back = sorted(tuple(r) for r in S.read_folds(spark, f"{tmp_dir}/folds").select("doc_id", "text", "class", "fold").collect())
    assert back == [(1, "t1", "a", 0), (2, "t2", "b", 1)]


def test_vocabulary_files(spark, tmp_dir):
    v = spark.createDataFrame([("kedi",), ("köpek",)], "term string")
    S.write_vocabulary(v, f"{tmp_dir}/vocab")
    held = spark.createDataFrame([("deniz",), ("kedi",)], "term string")
    got = sorted(r.term for r in S.read_vocabulary(spark, f"{tmp_dir}/vocab", held).collect())
    assert got == ["deniz", "kedi", "köpek"]


def test_load_or_build_builds_once(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3).withColumnRenamed("id", "doc_id")

    p = f"{tmp_dir}/table"
    assert S.load_or_build(spark, p, build).count() == 3
    assert S.load_or_build(spark, p, build).count() == 3
    assert len(calls) == 1


def test_metrics_and_fold_csv(spark, tmp_dir):
    m = spark.createDataFrame([("a", 0.5, 0.5, 0.5)], "class string, precision double, recall double, f1 double")
    S.write_metrics_csv(m, f"{tmp_dir}/metrics")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/metrics").first()
    assert back["class"] == "a" and float(back.f1) == 0.5
    split = spark.createDataFrame([(0, "test", 2, "a"), (0, "train", 1, "b")], "fold int, split string, doc_id long, class string")
    S.write_fold_csv(split, f"{tmp_dir}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv").where("split = 'train'").count() == 1


def test_require_columns(spark):
    with pytest.raises(ValueError):
        S.require_columns(spark.range(1), ["doc_id", "text"])


def test_paths_are_ranked_by_many_tasks(spark, tmp_dir):
    for i in range(60):
        os.makedirs(f"{tmp_dir}/c{i % 3}", exist_ok=True)
        with open(f"{tmp_dir}/c{i % 3}/f{i:03d}.txt", "w") as fh:
            fh.write(f"text {i}")
    docs = S.read_labelled_directory(spark, tmp_dir, clean=False).orderBy("doc_id").collect()
    assert [r.doc_id for r in docs] == list(range(60))
    want = sorted((f"c{i % 3}/f{i:03d}", f"text {i}") for i in range(60))
    assert [r.text for r in docs] == [t for _, t in want]
    from lexiflow.operators.ranking import range_rank

    paths = spark.createDataFrame([(f"file:/x/{p}",) for p, _ in want], "path string")
    ranked = range_rank(paths, "path", "n")
    assert [r.n for r in ranked.orderBy("path").collect()] == list(range(60))
    assert ranked.inputFiles() and len(ranked.inputFiles()) > 2  # written by more than one task


def test_fold_csv_is_written_by_many_tasks(spark, tmp_dir):
    rows = [(f, s, d, "a") for f in range(3) for s, n in (("test", 5), ("train", 400)) for d in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together again
    S.write_fold_csv(spark.createDataFrame(rows, "fold int, split string, doc_id long, class string"), f"{tmp_dir}/csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for _, _, fs in os.walk(f"{tmp_dir}/csv") for f in fs if f.startswith("part-")]
    assert len(files) > 6
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert back.count() == len(rows)


def test_half_written_artefact_is_built_again(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/half")
    with open(f"{tmp_dir}/half/part-00000.parquet", "w") as fh:
        fh.write("broken")
    assert S.load_or_build(spark, f"{tmp_dir}/half", lambda: spark.range(4)).count() == 4


def test_an_artefact_fits_its_parameters_and_files(spark, tmp_dir):
    from lexiflow.operators.tfidf import TfidfConfig

    spark.range(2).write.parquet(f"{tmp_dir}/in")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    get = lambda cfg: S.load_or_build(spark, f"{tmp_dir}/out", build, params=cfg, inputs=[f"{tmp_dir}/in"]).count()
    assert get(TfidfConfig(min_df=1)) == 3 and get(TfidfConfig(min_df=1)) == 3 and len(calls) == 1
    get(TfidfConfig(min_df=2))  # other parameters: built again
    assert len(calls) == 2
    get(TfidfConfig(min_df=2))
    assert len(calls) == 2
    spark.range(5).write.mode("append").parquet(f"{tmp_dir}/in")  # another input file
    get(TfidfConfig(min_df=2))
    assert len(calls) == 3
    os.remove(f"{tmp_dir}/out/{S.MANIFEST}")  # as after a write that did not finish
    get(TfidfConfig(min_df=2))
    assert len(calls) == 4 and os.path.exists(f"{tmp_dir}/out/{S.MANIFEST}")


@pytest.mark.parametrize("bytes_per_task", ["150b", "128m"])
@pytest.mark.parametrize("layout", [{"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_folds_json_by_byte_ranges(spark, tmp_dir, bytes_per_task, layout):
    """Escapes, quotes, braces and line ends in texts, cut at any place; classes before texts in one fold."""
    import random

    r = random.Random(4)
    awkward = ["", '"', '\\', 'a", "b', '\\"', 'x\\', '{"text": {"1": "no"}}', "}, {", "ü \n\t é 😀", ": {", '", ', '\\", \\"', "null", "[1, 2]", "\r\n"]
    text = lambda: "".join(r.choice(awkward + ["w ", "zz "]) for _ in range(r.randrange(6)))
    want, doc = [], {}
    for fold in range(3):
        ids = r.sample(range(fold * 100, fold * 100 + 100), 12)
        rows = [(i, text(), r.choice(["a", "b \"q\"", None]), fold) for i in ids]
        want += rows
        sections = {"text": {str(i): t for i, t, _, _ in rows}, "class": {str(i): c for i, _, c, _ in rows}}
        doc[str(fold)] = dict(reversed(sections.items())) if fold == 1 else sections
    path = f"{tmp_dir}/folds.json"
    with open(path, "w", encoding="utf-8", newline="") as fh:
        json.dump(doc, fh, **layout)
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        tasks = spark.read.option("lineSep", '"').text(path).rdd.getNumPartitions()
        assert tasks > 10 or bytes_per_task != "150b"
        got = S.read_folds_json(spark, path).select("doc_id", "text", "class", "fold").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_nested_folds_written_by_many_tasks(spark, tmp_dir):
    """The files together are the document, for this reader and for any other."""
    rows = [(i, ['say "x"', "a\\", "", "line\nend", "é 😀", None][i % 6], [None, "c", "d"][i % 3], i % 4) for i in range(300)]
    folds = spark.createDataFrame(rows, "doc_id long, text string, class string, fold int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    S.write_folds_json(folds, f"{tmp_dir}/nested")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(f for f in os.listdir(f"{tmp_dir}/nested") if f.startswith("part-"))
    assert len(files) > 3
    doc = json.loads("".join(open(f"{tmp_dir}/nested/{f}", encoding="utf-8").read() for f in files))
    assert sorted((int(i), t, f["class"][i], int(k)) for k, f in doc.items() for i, t in f["text"].items() if t is not None) == sorted(r for r in rows if r[1] is not None)
    got = S.read_folds_json(spark, f"{tmp_dir}/nested").select("doc_id", "text", "class", "fold").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))
