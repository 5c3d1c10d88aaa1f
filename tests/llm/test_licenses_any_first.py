import pytest

from lexiflow.llm import licenses

from .conftest import texts_frame


def test_template_that_begins_with_any_words(spark):
    templates = {"own": "<<var;name=owner;min=1;max=3>> <<beginOptional>>hereby<<endOptional>> grants use"}
    rows = [(1, "Some Body grants use", None, None), (2, "grants use", None, None), (3, "a b c d hereby grants use", None, None)]
    got = {r.doc_id: [(m["word"], m["words"], m["literal"]) for m in r.matches]
           for r in licenses.scan_licenses(texts_frame(spark, rows), templates=templates).collect()}
    # as read from every place
    a = licenses.compile_template(templates["own"])
    want = {i: [(p, *f) for p in range(len(t.split())) if (f := a.read(t.lower().split(), p))] for i, t, *_ in rows}
    assert got == want and got[1] and not got[2] and got[3]


def test_template_without_a_word_is_refused():
    with pytest.raises(ValueError):
        licenses.Scanner({}, {"any": "<<var;name=x;min=1;max=4>> <<beginOptional>>a<<endOptional>>"})
