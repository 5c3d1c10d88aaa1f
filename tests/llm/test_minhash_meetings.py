import random

import pytest

from lexiflow.llm import minhash

from .conftest import texts_frame
from .test_minhash import answer, brute


@pytest.mark.parametrize("earlier", [1, 4])
def test_copies_meet_once_and_keep_every_link(spark, monkeypatch, earlier):
    """Prefixes of near copies share runs of items: a pair in different components meets at the first of a run only,
    and no link is lost."""
    monkeypatch.setattr(minhash, "EARLIER", earlier)
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows, line = [], list(base)
    for i in range(120):
        copy = list(base if i % 3 else line)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        if i % 3 == 0:
            line = copy
        rows.append((i, " ".join(copy)))
    assert answer(minhash.near_duplicates(texts_frame(spark, [(i, t, None, None) for i, t in rows]))) == brute(rows)


def test_meetings_of_two_copies(spark):
    """Two sets with 40 of 44 items in common, in two components: one meeting in the join, where there was one for each shared prefix item."""
    sets = spark.createDataFrame([(1, 11, list(range(44))), (2, 12, list(range(4, 48)))], "node long, own long, items array<long>")
    members = spark.createDataFrame([(7, 1), (7, 2)], "band long, node long")
    parts = spark.createDataFrame([(1, 1), (2, 2)], "node long, component long")
    pairs = minhash._across(members, parts, sets, 75)
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
    plan = pairs._jdf.queryExecution().executedPlan()
    assert "arrays_overlap" in plan.toString()
