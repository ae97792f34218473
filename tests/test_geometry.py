"""Predicates on literal drawings, and range operators against loops."""

import random

import pytest
from pyspark.sql import functions as F

from itemforge.functions import geometry as G
from itemforge.functions import scalar as S
from itemforge.operators import layout, lookup
from itemforge.operators import windows as O
from tests.test_layout import DRAW


def draw(x0, y0, x1, y1, items, fill=None, color=(0.0, 0.0, 0.0), width=1.0, dashes=""):
    return ("d", 1, float(x0), float(y0), float(x1), float(y1), "s", fill, list(color), width, dashes, items)


def seg(cmd, *pts):
    return (cmd, [(float(x), float(y)) for x, y in pts])


CURVE = seg("c", (0, 0), (1, 1), (2, 2), (3, 3))
CASES = {
    "curve": (draw(100, 100, 130, 130, [CURVE]), True),
    "tiny curve": (draw(100, 100, 105, 105, [CURVE]), False),
    "box": (draw(100, 100, 180, 160, [seg("re", (100, 100), (180, 160))]), True),
    "table rule": (draw(100, 100, 240, 100.5, [seg("l", (100, 100), (240, 100))]), False),
    "slanted": (draw(100, 100, 140, 140, [seg("l", (100, 100), (140, 140))]), True),
    "dashed": (draw(100, 100, 150, 100.2, [seg("l", (100, 100), (150, 100))], dashes="[3 3] 0"), True),
    "dotted separator": (draw(100, 100, 330, 100.2, [seg("l", (100, 100), (330, 100))], dashes="[1 1] 0"), False),
    "page frame": (draw(30, 45, 560, 700, [CURVE]), False),
    "footer": (draw(100, 740, 130, 760, [CURVE]), False),
    "path": (draw(100, 100, 140, 140, [seg("l", (100, 100), (100, 140)), seg("l", (100, 140), (140, 140)), seg("l", (140, 140), (140, 100))]), True),
    "oblique quad": (draw(100, 100, 110, 110, [seg("qu", (100, 100), (110, 105), (110, 110), (100, 105))]), True),
    "no items": (draw(100, 100, 130, 130, []), False),
}


def test_vector_figures(spark):
    df = spark.createDataFrame([c for c, _ in CASES.values()], DRAW)
    got = [r[0] for r in df.select(G.vector_figure(F.lit(745.0))).collect()]
    assert dict(zip(CASES, got)) == {k: v for k, (_, v) in CASES.items()}


def test_rings_noise_glyphs_and_circles(spark):
    ring = draw(100, 100, 115, 115, [CURVE] * 4, None, (0.0, 0.6, 0.2), 2.0)
    dot = draw(100, 100, 104, 104, [CURVE])
    glyph = draw(100, 100, 105, 108, [CURVE] * 5, [0.0])
    circle = draw(100, 100, 106.9, 106.9, [CURVE] * 4, [0.1])
    df = spark.createDataFrame([ring, dot, glyph, circle], DRAW)
    rows = df.select(G.answer_ring(), G.cluster_noise(F.lit(745.0)), G.outlined_glyph(), G.answer_circle()).collect()
    assert [tuple(r) for r in rows] == [(True, False, False, False), (False, True, False, False), (False, False, True, False), (False, False, True, True)]
    null = spark.createDataFrame([("d", 1) + (None,) * 10], DRAW)
    assert tuple(null.select(G.vector_figure(F.lit(745.0)), G.answer_ring(), G.cluster_noise(F.lit(745.0)), G.outlined_glyph()).first()) == (False, False, True, False)


def test_outlined_words_and_clusters(spark):
    glyphs = [draw(100 + 6 * k, 100, 105 + 6 * k, 108, [CURVE] * 4, [0.0]) for k in range(3)]
    apart = [draw(100 + 20 * k, 200, 105 + 20 * k, 212, [CURVE] * 4, [0.0]) for k in range(3)]
    df = spark.createDataFrame(glyphs + apart, DRAW).withColumn("ord", F.when(F.col("y0") == 100, 1).otherwise(2)).withColumn("co_posicao", F.col("ord")).withColumn("tp_lingua", F.lit(None).cast("double"))
    assert [r.co_posicao for r in layout.outlined_words(df).collect()] == [1]
    assert layout.clusters(df).collect() == []
    assert [r.co_posicao for r in layout.clusters(df.unionByName(df).where("ord = 2")).collect()] == [2]


def test_circle_alternatives(spark):
    cols = spark.createDataFrame([("d", 1, 600.0)], "doc_id string, page_no int, mid double")
    heads = spark.createDataFrame([("d", 1, 7, 50.0, 90.0)], "doc_id string, page_no int, co_posicao int, x0 double, y0 double")
    spots = [(60, 100), (60, 120), (60, 140), (340, 100), (340, 120)]
    dots = spark.createDataFrame([draw(x, y, x + 6.9, y + 6.9, [CURVE] * 4, [0.0]) for x, y in spots], DRAW)
    lines = spark.createDataFrame([("d", 1, x + 10.0, y + 1.0, t) for (x, y), t in zip(spots, "abcde") if t != "e"], "doc_id string, page_no int, x0 double, y0 double, text string")
    row = layout.circle_alternatives(dots, heads, lines, cols).first()
    assert (row.co_posicao, row.alternativas) == (7, ["a", "b", "c", "d", S.PICTURE])


def test_intervals_equal_loops(spark):
    rng = random.Random(5)
    objects = [(g, i, rng.uniform(0, 50)) for i, g in enumerate(rng.choices([1, 2], k=40))]
    regions = [(g, o, a := rng.uniform(0, 45), a + rng.uniform(0, 10)) for o, g in enumerate(rng.choices([1, 2], k=15))]
    od = spark.createDataFrame(objects, "g int, oid int, at double")
    rd = spark.createDataFrame(regions, "g int, ord int, lo double, hi double")
    first = {}
    for g, i, at in objects:
        for h, o, lo, hi in regions:
            if g == h and lo - 2 <= at <= hi + 2:
                first[i] = o
                break
    assert {r.oid: r.ord for r in lookup.first_interval(od, rd, ["g"], "at", "lo", "hi", "ord", 2.0, "oid").collect()} == first
    spans = [(g, lo, hi) for g, _, lo, hi in regions]
    got = {r.g: round(r.covered, 6) for r in O.covered_length(spark.createDataFrame(spans, "g int, a double, b double"), ["g"], "a", "b", 1.0).collect()}
    for g in {1, 2}:
        total, cur = 0.0, None
        for a, b in sorted((a, b) for h, a, b in spans if h == g):
            if cur and a - cur[1] <= 1.0:
                cur = (cur[0], max(cur[1], b))
            else:
                total += cur[1] - cur[0] if cur else 0
                cur = (a, b)
        assert got[g] == pytest.approx(total + cur[1] - cur[0])


def test_casts_and_rules(spark):
    df = spark.createDataFrame([("3", "3"), ("3.0", "1,5"), ("3.5", "x"), (" 7 ", ""), ("abc", None), (None, "1e3")], "a string, b string")
    assert [tuple(r) for r in df.select(S.safe_long(F.col("a")), S.safe_double(F.col("b"))).collect()] == [(3, 3.0), (3, None), (None, None), (7, None), (None, None), (None, 1000.0)]
    areas = spark.createDataFrame([("cn", 2016), ("CN", 2017), (" lc", 2010), ("LC", 2020), ("XX", 2020), (None, 2020)], "a string, y int")
    assert [r[0] for r in areas.select(S.exam_day(F.col("a"), F.col("y"))).collect()] == [1, 2, 2, 1, None, None]
    with pytest.raises(Exception, match="unknown area"):
        areas.select(S.exam_day(F.col("a"), F.col("y"), strict=True)).collect()
    assert [r[0] for r in spark.createDataFrame([(" amarela ",), ("Roxo",), (None,)], "c string").select(S.colour(F.col("c"))).collect()] == ["AMARELO", None, None]


def test_blocks_equal_whole_windows(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2, None]), k, rng.choice([None, None, 1, 2, 3])) for k in range(200)]
    df = spark.createDataFrame(rows, "g int, k int, v int")
    for make in (lambda b: O.carry_forward(df, ["g"], ["k"], "v", "x", b), lambda b: O.running_count(df, ["g"], ["k"], F.col("v") == 1, "x", b)):
        assert sorted(map(tuple, make(16).select("k", "x").collect())) == sorted(map(tuple, make(None).select("k", "x").collect()))
