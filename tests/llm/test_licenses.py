import itertools
import re

import pytest

from lexiflow.llm import licenses, queries

from .conftest import texts_frame

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    w = words(text)
    found = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def wordings(template):
    """All readings of a template without any-word regions."""
    parts = re.split(r"<<(.*?)>>", template)
    out, optional = [[[]]], []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            out[-1] = [x + part.split() for x in out[-1]]
        elif part == "beginOptional":
            optional.append(out[-1])
            out.append(list(out[-1]))
        elif part == "endOptional":
            inner = out.pop()
            out[-1] = inner + optional.pop()
        else:
            match = part.split("match=")[1].split(";")[0].split("|")
            out[-1] = [x + m.split() for x in out[-1] for m in match]
    return {" ".join(x) for x in out[0]}


@pytest.mark.parametrize("name", [n for n, t in licenses.TEMPLATES.items() if "min=" not in t])
def test_automaton_accepts_its_wordings_and_nothing_less(name):
    a = licenses.compile_template(licenses.TEMPLATES[name])
    good = wordings(licenses.TEMPLATES[name])
    for text in good:
        w = text.split()
        assert a.read(["x", *w, "y"], 1)[0] == len(w)
        for k in range(len(w)):
            for other in (w[:k] + w[k + 1:], w[:k] + ["zzz"] + w[k + 1:]):
                found = a.read(other, 0)
                assert not found or " ".join(other[:found[0]]) in good


def test_any_words_and_nesting():
    a = licenses.compile_template("a <<var;name=x;min=1;max=2>> <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d")
    for middle, tail in itertools.product((["q"], ["q", "r"]), ([], ["b"], ["b", "c"])):
        text = ["a", *middle, *tail, "d"]
        assert a.read(text, 0)[0] == len(text)
    assert a.read(["a", "d"], 0) is None and a.read("a q r s d".split(), 0) is None and a.read("a q c d e".split(), 0)[0] == 4
    assert a.read("a d d".split(), 0) == (3, 2)
    for bad in ("<<beginOptional>> a", "<<other>> a"):
        with pytest.raises(ValueError):
            licenses.compile_template(bad)


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op5_license_templates(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates_in_texts(spark, awkward, nothing):
    rows = [(1, "x. Licensed under the Apache License, Version 2.0.\nAll rights  reserved, all rights reserved", None, None),
            (2, "Released under the MIT License.", None, None), (3, "Copyright (c) 2020 The Some People. All rights reserved", None, None),
            (4, "licensed under the apache software license 2.0", None, None), (5, "Licensed under Creative Commons Attribution 4.0", None, None)]
    got = {r.doc_id: (sorted(m["label"] for m in r.matches), len(r.places)) for r in licenses.scan_licenses(texts_frame(spark, rows)).collect()}
    assert got == {1: (["apache-2.0"], 2), 2: (["mit"], 0), 3: (["copyright-notice"], 1), 4: ([], 0), 5: (["cc-by-4.0"], 0)}
    out = licenses.scan_licenses(awkward).collect()
    assert sorted(r.n_words for r in out) == sorted(len(words(r["text"])) for r in awkward.collect())
    assert licenses.scan_licenses(nothing).collect() == []
    assert all(not r.matches for r in licenses.scan_licenses(awkward, templates={}).collect())
