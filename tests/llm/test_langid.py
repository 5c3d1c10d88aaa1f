import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexiflow.llm import langid, queries
from lexiflow.llm.shingles import utf8_buffers

from .conftest import texts_frame

SF = "/root/testdata/sf0.01"


def test_trigrams_stay_inside_their_text():
    raw, offsets = utf8_buffers(pa.array(["abc", None, "", "bc", " 12 é"]))
    gram, count = langid.trigrams(raw, offsets)
    assert count.tolist() == [3, 0, 0, 2, 2]
    alone, _ = langid.trigrams(*utf8_buffers(pa.array(["bc"])))
    assert gram[3:5].tolist() == alone.tolist()


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 60):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2) and (np.abs(code.sum(axis=0)) < n).all()


def test_a_flipped_bit_is_corrected():
    """The nearest codeword stands although one classifier is wrong."""
    counts = {x: np.random.default_rng(i).integers(0, 50, langid.BUCKETS).astype(float) for i, x in enumerate("abcd")}
    model = langid.fit(counts)
    model.ratio[:, 2] *= -1
    gram = np.repeat(np.arange(langid.BUCKETS), counts["c"].astype(int))
    total = model.ratio[gram].mean(axis=0)
    loss = (np.exp(-np.clip(total - model.shift, -4, 4) * model.code) * model.weight).sum(axis=1)
    assert model.languages[loss.argmin()] == "c"


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op9_language_codes(spark, SF).collect()
    assert len(got) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in own) >= 0.98 * len(own)


def test_nothing_is_learned_from_held_out_rows(spark):
    rows = [(i, "aaa bbb", "x" if zlib.crc32(str(i).encode()) % 4 != 2 else "secret", None) for i in range(40)]
    counts = langid.language_counts(texts_frame(spark, rows), ~langid.held_out())
    assert set(counts) == {"x"} and counts["x"].sum() == 6 * sum(r[2] == "x" for r in rows)


def test_awkward_rows(spark, awkward, nothing):
    model = langid.fit(langid.language_counts(awkward, ~langid.held_out()))
    got = langid.identify(awkward, model).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].lang_pred == by[2].lang_pred == by[9].lang_pred == "und" and by[1].score == 0
    assert by[7].lang_pred != "und" and by[10].lang_pred != "und"
    assert langid.identify(nothing, model).collect() == []
    unlearned = langid.fit(langid.language_counts(awkward, F.lit(False)))
    assert {r.lang_pred for r in langid.identify(awkward, unlearned).collect()} == {"und"}
    only = langid.fit({"x": np.ones(langid.BUCKETS)})
    assert {r.lang_pred for r in langid.identify(awkward, only).collect()} == {"und", "x"}


def test_predictions_equal_plain_python(spark):
    """Counts, margins, losses and scores worked out again letter by letter with dictionaries."""
    import itertools
    import math

    texts = {"en": "the cat sat on the mat and the dog ran", "de": "der hund und die katze sind über der straße",
             "fr": "le chat est sur la table et le chien", "es": "el perro y el gato están en la casa"}
    rows = [(i, " ".join(t.split()[i % 5:]) + f" {i}", lang, "s") for i, (lang, t) in enumerate(itertools.islice(itertools.cycle(texts.items()), 48))]
    rows += [(100, None, "en", "s"), (101, "12 34", "de", "s"), (102, "hund cat chat", None, "s"), (None, "der die das", "de", "s"), (103, "a", "en", "s")]

    def grams(text):
        data = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()]
        data = [32, *data, 32]
        return [((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> 17 for a, b, c in zip(data, data[1:], data[2:]) if b != 32]

    count = {}
    for i, t, lang, _ in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            own = count.setdefault(lang, {})
            for g in grams(t):
                own[g] = own.get(g, 0) + 1
    langs = sorted(count)
    total = {x: sum(count[x].values()) + 0.5 * langid.BUCKETS for x in langs}
    mean = lambda side, g: sum((count[x].get(g, 0) + 0.5) / total[x] for x in side) / len(side)
    bits = []
    for split in range(2 ** (len(langs) - 1) - 1):
        up = [langs[0]] + [x for i, x in enumerate(langs[1:]) if split >> i & 1]
        down = [x for x in langs if x not in up]
        ratio = [math.log(mean(up, g) / mean(down, g)) for g in range(langid.BUCKETS)]
        top = sum(mean(up, g) * r for g, r in enumerate(ratio))
        bottom = sum(mean(down, g) * r for g, r in enumerate(ratio))
        bits.append((up, ratio, top, bottom))
    apart = sum(b[2] - b[3] for b in bits)
    model = langid.fit(langid.language_counts(texts_frame(spark, rows), ~langid.held_out()))
    got = {r.doc_id: r for r in langid.identify(texts_frame(spark, rows), model).collect()}
    for i, t, _, _ in rows:
        own = grams(t)
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        loss = dict.fromkeys(langs, 0.0)
        for up, ratio, top, bottom in bits:
            margin = sum(2 * ratio[g] / (top - bottom) for g in own) / len(own) - (top + bottom) / (top - bottom)
            margin = max(-4.0, min(4.0, margin))
            for x in langs:
                loss[x] += math.exp(-margin if x in up else margin) * (top - bottom) / apart
        best = min(langs, key=loss.get)
        score = 1 / sum(math.exp(4 * (loss[best] - v)) for v in loss.values())
        order = sorted(loss.values())
        assert abs(got[i].score - score) < 1e-3 and abs(loss[got[i].lang_pred] - order[0]) < 1e-3
        if abs(order[1] - order[0] - langid.AMBIGUOUS) > 1e-3:
            assert got[i].ambiguous == (order[1] - order[0] < langid.AMBIGUOUS)
