import random

import corpus_pipeline
from lexiflow.llm import pii

from .conftest import SF, texts_frame
from .test_exact_dedup import brute as equal_texts
from .test_minhash import brute as near_copies
from .test_packing import check
from .test_rules import brute as rule_counts


def test_stages_match_brute_force(spark):
    """Each stage on all that the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r for r in left.collect()}
        left = corpus_pipeline.stored(stage(spark, left, SF), name)
        assert left.columns == docs.columns
        now = {r.doc_id: r for r in left.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        if name == "quality_rules":
            base = {i for i, t in texts if not rule_counts(t)[5]}
            assert set(now) <= base and len(now) > 0.9 * len(base)
        if name == "exact_duplicates":
            assert set(now) == {i for i, _, _, kept, _ in equal_texts(texts) if kept}
        if name == "near_duplicates":
            assert set(now) == {i for i, (_, c) in near_copies(texts).items() if c == i}
        if name == "personal_data":
            assert set(now) == set(before)
            assert all(pii.base_spans(r.text) == [] and r.n_chars == len(r.text) for r in now.values())
            changed = [i for i in now if now[i].text != before[i].text]
            assert set(changed) >= {i for i, t in texts if pii.base_spans(t)}
        assert all(now[i].lang == rows[i].lang for i in now)
    final = corpus_pipeline.STAGES[4][1](spark, left, SF).collect()
    check(final, [(i, r.text) for i, r in now.items()])


def test_run_equals_its_stages_on_awkward_rows(spark, awkward, nothing, tmp_dir):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**5)}" for _ in range(80))
    docs = awkward.union(texts_frame(spark, [(50, long, "en", "a"), (51, long, "en", "a"), (51, long, "en", "a"), (None, long, "en", "a"),
                                             (60, long + " tail a@b.org", "en", "b"), (61, " ".join(f"v{i}" for i in range(70)), None, None)]))
    docs.write.parquet(f"{tmp_dir}/a/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_dir}/a").collect()
    assert sorted(r.doc_id for r in got) == [51, 61]
    nothing.write.parquet(f"{tmp_dir}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_dir}/b").collect() == []
