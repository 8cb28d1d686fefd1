import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from glyphledger.functions import geometry as G
from glyphledger.operators.glyphs import normalize_glyphs

SQUARE = [(0, 0), (0, 100), (100, 100), (100, 0)]  # clockwise with y up
SCHEMA = f"id string, glyph_type string, units_per_em int, contours {G.CONTOURS}, advance_width double, lsb double"


def outline(*contours):
    return [[(float(x), float(y), True) for x, y in c] for c in contours]


def norm(spark, rows, **kw):
    df = spark.createDataFrame(
        [(i, t, u, c, a, l) for i, (t, u, c, a, l) in rows.items()], SCHEMA
    )
    return {r["id"]: r for r in normalize_glyphs(df, **kw).collect()}


def simple(*contours, upm=1024):
    return ("simple", upm, outline(*contours), 500.0, 10.0)


def rotated(points, k):
    return points[k:] + points[:k]


def test_start_does_not_matter(spark):
    got = norm(spark, {str(k): simple(rotated(SQUARE, k)) for k in range(4)})
    assert len({r["glyph_hash"] for r in got.values()}) == 1
    assert all((p["x"], p["y"]) == (0, 0) for p in [got[k]["contours"][0][0] for k in got])


def test_contour_order_does_not_matter(spark):
    small = [(10, 10), (10, 20), (20, 20), (20, 10)]
    got = norm(spark, {"a": simple(SQUARE, small), "b": simple(small, SQUARE)})
    assert got["a"]["glyph_hash"] == got["b"]["glyph_hash"]


def test_direction_matters_unless_fixed_first(spark):
    # The start is fixed before the direction, so a reversed copy keeps another start.
    rows = {"cw": simple(SQUARE), "ccw": simple(SQUARE[::-1])}
    plain = norm(spark, rows)
    assert plain["cw"]["glyph_hash"] != plain["ccw"]["glyph_hash"]
    fixed = norm(spark, rows, reorient_first=True)
    assert fixed["cw"]["glyph_hash"] == fixed["ccw"]["glyph_hash"]


def test_stored_contours_keep_their_direction(spark):
    got = norm(spark, {"ccw": simple(SQUARE[::-1])})["ccw"]
    area = sum(
        p["x"] * q["y"] - q["x"] * p["y"]
        for p, q in zip(got["contours"][0], got["contours"][0][1:] + got["contours"][0][:1], strict=True)
    )
    assert area > 0


def test_scaling_unifies_units(spark):
    half = [(x / 2, y / 2) for x, y in SQUARE]
    got = norm(spark, {"a": simple(SQUARE), "b": simple(half, upm=512)})
    assert got["a"]["glyph_hash"] == got["b"]["glyph_hash"]
    assert (got["b"]["upm_changed"], got["b"]["source_upm"], got["b"]["advance_width"]) == (True, 512, 1000.0)
    assert (got["a"]["upm_changed"], got["a"]["source_upm"]) == (False, None)


def test_rounding_is_half_even_at_four_places(spark):
    v = spark.createDataFrame([(2.00005,), (2.00015,), (-0.00004,), (1.23456,)], ["v"])
    assert [r[0] for r in v.select(G.half_even(F.col("v"))).collect()] == [2.0, 2.0002, 0.0, 1.2346]
    near = [(x + 0.00001, y) for x, y in SQUARE]
    got = norm(spark, {"a": simple(SQUARE), "b": simple(near)})
    assert got["a"]["glyph_hash"] == got["b"]["glyph_hash"]


def test_empty_and_composite(spark):
    got = norm(
        spark,
        {"e": ("empty", 512, [], 300.0, 0.0), "c": ("composite", 1024, None, 300.0, 0.0), "s": simple(SQUARE)},
    )
    assert (got["e"]["glyph_hash"], got["e"]["upm_changed"], got["e"]["advance_width"]) == ("empty", False, 300.0)
    assert got["c"]["glyph_hash"] is None and got["c"]["error"]
    assert got["s"]["error"] is None


def test_two_point_contour(spark):
    got = norm(spark, {"a": simple([(5, 5), (0, 1)])})["a"]
    assert [(p["x"], p["y"]) for p in got["contours"][0]] == [(0, 1), (5, 5)]


def reference_hash(contours):
    """Digest rules written out plainly for the test."""
    done = []
    for c in contours:
        pts = [(round(x, 4), round(y, 4), on) for x, y, on in c]
        k = min(range(len(pts)), key=lambda i: (pts[i][0] + pts[i][1], i))
        done.append(pts[k:] + pts[:k])

    def box(c):
        xs, ys = [p[0] for p in c], [p[1] for p in c]
        return (max(xs) - min(xs)) * (max(ys) - min(ys))

    done.sort(key=lambda c: (-box(c), min(p[0] + p[1] for p in c)))
    out = []
    for c in done:
        area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(c, c[1:] + c[:1], strict=True)) / 2
        c = c[::-1] if len(c) >= 3 and area > 0 else c
        out.append([{"x": p[0], "y": p[1], "on_curve": p[2]} for p in c])
    text = json.dumps(out, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def test_json_fingerprint_equals_plain_rules(spark):
    rnd = random.Random(7)
    shapes = {
        str(i): [
            [(rnd.choice([0.0001, 1e7, -3.5, 0.0, rnd.uniform(-900, 900)]), rnd.uniform(-900, 900), rnd.random() < 0.6) for _ in range(rnd.randint(2, 9))]
            for _ in range(rnd.randint(1, 4))
        ]
        for i in range(40)
    }
    got = norm(spark, {k: ("simple", 1024, c, 1.0, 1.0) for k, c in shapes.items()}, compat=True)
    assert {k: r["glyph_hash"] for k, r in got.items()} == {k: reference_hash(c) for k, c in shapes.items()}


@pytest.mark.parametrize(
    "other, want",
    [
        (SQUARE, 0.95),
        ([(x + 1.9, y) for x, y in SQUARE], 0.95),
        ([(x + 2.0, y) for x, y in SQUARE], 0.9),
        ([(x + 10, y + 4) for x, y in SQUARE], 0.5),
        ([(x + 40, y) for x, y in SQUARE], 0.0),
        ([(x, y * 1.04) for x, y in SQUARE], 0.9),
        ([(x, y * 1.06) for x, y in SQUARE], 0.0),
        (SQUARE[:3], 0.0),
    ],
)
def test_geo_similarity(spark, other, want):
    df = spark.createDataFrame([(outline(SQUARE), outline(other))], f"a {G.CONTOURS}, b {G.CONTOURS}")
    assert df.select(G.geo_similarity(F.col("a"), F.col("b"))).first()[0] == pytest.approx(want)


def test_geo_similarity_of_empty_outlines(spark):
    df = spark.createDataFrame([([], [])], f"a {G.CONTOURS}, b {G.CONTOURS}")
    assert df.select(G.geo_similarity(F.col("a"), F.col("b"))).first()[0] == 1.0


def test_shortest_text_equals_python(spark):
    rnd = random.Random(3)
    values = [0.0, -0.0, 0.0001, -0.0001, 0.1, 7.0, -12.5, 1e7, 123456789.0625, 99999999999.9999, 1e11, -3e12]
    values += [rnd.choice([1, -1]) * rnd.randrange(10**rnd.randrange(1, 14)) / 10000 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], ["v"])
    got = [r[0] for r in df.select(G.shortest_text(F.col("v"))).collect()]
    assert [g for g, v in zip(got, values, strict=True) if abs(v) < 1e11] == [repr(v) for v in values if abs(v) < 1e11]
    assert [float(g) for g in got] == values


def test_json_digest_runs_without_python(spark):
    df = spark.createDataFrame([([[(0.5, 1.0, True)]],)], f"c {G.CONTOURS}")
    plan = df.select(G.glyph_hash(F.col("c"), compat=True))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
