"""cleaning edge cases; idempotence of the letters-only cleaning."""

from pyspark.sql import functions as F

from lexiflow.functions.text import sanitize_chars, sanitize_text, sanitize_tokens

F1 = [
    ("a ve b", True, "a b "),
    ("a1 b. c", True, "c "),
    ("foo\nbar x", True, "x "),
    ("foo\n x", True, "x "),
    ("Ve ve", True, "Ve "),
    ("a  b", True, "a b "),
    ("a  b", False, "a  b "),
    ("", True, ""),
]


def test_f1_clean(spark):
    rows = [(t,) for t, _, _ in F1]
    df = spark.createDataFrame(rows, "text string")
    got_t = [r[0] for r in df.select(sanitize_text("text", ("ve",), True)).collect()]
    got_f = [r[0] for r in df.select(sanitize_text("text", ("ve",), False)).collect()]
    for (t, alpha, want), gt, gf in zip(F1, got_t, got_f):
        assert (gt if alpha else gf) == want, (t, alpha)


def test_f1_tokens_keep_empty_when_not_alpha(spark):
    df = spark.createDataFrame([("a  b",)], "text string")
    assert df.select(sanitize_tokens("text", ("ve",), False)).first()[0] == ["a", "", "b"]
    assert df.select(sanitize_tokens("text", ("ve",), True)).first()[0] == ["a", "b"]


def test_chars_drop_single_letter_stop_word(spark):
    df = spark.createDataFrame([("foo b1r x",)], "text string")
    assert df.select(sanitize_chars("text", ("o",), True)).first()[0] == "f br x "


def test_clean_is_idempotent(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    once = df.select(sanitize_text("text").alias("t"))
    twice = once.select(F.col("t"), sanitize_text("t").alias("t2"))
    assert twice.where("t != t2").count() == 0
