import pytest

SF = "/root/testdata/sf0.001"


def texts_frame(spark, rows):
    """documents with awkward rows: (doc_id, text, lang, source); n_chars and a clashing extra column follow."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, host string"
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "x") for i, t, la, s in rows], schema)


@pytest.fixture()
def awkward(spark):
    return texts_frame(spark, [
        (1, None, "en", "a"), (2, "", None, None), (3, "same text here", "en", "a"), (3, "same text here", "en", "a"),
        (None, "same text here", "en", "b"), (7, "word " * 60000, "en", "a"), (8, "x" * 100000, "fr", "a"),
        (9, " \t\n\r\v\f ", "en", "b"), (10, "é ü   　 ß 😀 #*$", "de", "b"), (None, None, None, None),
    ])


@pytest.fixture()
def nothing(spark):
    return texts_frame(spark, [])
