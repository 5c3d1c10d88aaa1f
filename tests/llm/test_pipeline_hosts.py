import corpus_pipeline

from .conftest import texts_frame


def test_same_document_under_two_hosts(spark):
    """A host's habit removes its own listing only."""
    text = lambda k, symbols: " ".join([f"w{k}x{i}" for i in range(70)] + ["#"] * symbols)
    both = text("both", 12)
    rows = [(i, text(i, 12), "en", "strict") for i in range(40)] + [(100 + i, text(100 + i, 0), "en", "mild") for i in range(60)]
    rows += [(200 + i, text(200 + i, 0), "en", None) for i in range(60)]
    rows += [(d, both, "en", h) for d in (900, None) for h in ("strict", "mild", None)]
    left = corpus_pipeline.quality_rules(spark, texts_frame(spark, rows), "").collect()
    assert {(r.doc_id, r.source) for r in left if r.text == both} == {(d, h) for d in (900, None) for h in ("mild", None)}
    assert len(left) == 120 + 4 and all(r.source != "strict" for r in left)
