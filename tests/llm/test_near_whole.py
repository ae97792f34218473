"""Near-duplicates that an incomplete candidate search loses."""

import random

from itemforge.llm import near
from tests.llm.test_operators import brute_pairs


def test_hot_run_pairs_texts_with_different_neighbours(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 7, raising=False)
    rows = [(0, "Assinale a alternativa correta.")] + [(k, f"Assinale a alternativa correta x{k} y{k}.") for k in range(1, 60)]
    got = {(r.id_a, r.id_b) for r in near.alike_pairs(spark.createDataFrame(rows, "i bigint, t string"), "i", "t", 0.5).collect()}
    assert got == brute_pairs(rows, 0.5) == {(0, k) for k in range(1, 60)}


def test_evenly_edited_pairs_equal_brute_force(spark):
    rng, rows = random.Random(11), []
    for size, gap in ((155, 9), (155, 10), (100, 9), (600, 9), (1300, 9)) * 8:
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        edited = [f"e{rng.randrange(400)}" if k % gap == gap - 1 else w for k, w in enumerate(base)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(edited))]
    got = {(r.id_a, r.id_b) for r in near.alike_pairs(spark.createDataFrame(rows, "i bigint, t string"), "i", "t", 0.5).collect()}
    want = brute_pairs(rows, 0.5)
    assert len(want) > 30 and got == want
