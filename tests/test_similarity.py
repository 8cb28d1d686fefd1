import random

import numpy as np
import pytest

from glyphledger.functions import geometry as G
from glyphledger.operators import similarity as sim

SCHEMA = f"group_id string, variant_id string, contours {G.CONTOURS}"


def box(x0, y0, x1, y1, cw=True):
    pts = [(x0, y0), (x0, y1), (x1, y1), (x1, y0)]
    return [(float(x), float(y), True) for x, y in (pts if cw else pts[::-1])]


def plain_similarity(a, b):
    """The comparison rules written out plainly for the test."""
    if [len(c) for c in a] != [len(c) for c in b]:
        return 0.0
    if not a:
        return 1.0

    def area(cs):
        xs, ys = [p[0] for c in cs for p in c], [p[1] for c in cs for p in c]
        return max(0.0, (max(xs) - min(xs)) * (max(ys) - min(ys)))

    big = max(area(a), area(b))
    if big > 0 and abs(area(a) - area(b)) / big > 0.05:
        return 0.0
    gaps = [max(abs(p[0] - q[0]), abs(p[1] - q[1])) for c, d in zip(a, b, strict=True) for p, q in zip(c, d, strict=True)]
    return 0.95 if max(gaps) < 2 else max(0.0, 1 - sum(gaps) / len(gaps) / 20)


def brute(rows, fn):
    out = {}
    for g in {r[0] for r in rows}:
        vs = [r[2] for r in rows if r[0] == g]
        out[g] = [fn(vs[i], vs[j]) for i in range(len(vs)) for j in range(i)]
    return out


@pytest.mark.parametrize("cell", [3, 512])
def test_least_similarity_equals_all_pairs(spark, cell):
    rnd = random.Random(11)
    rows = []
    for g, (jitter, n) in enumerate([(0.3, 9), (0.9, 12), (1.5, 17), (6, 11), (15, 8), (60, 7), (1.2, 2), (9, 2), (1, 1)]):
        for v in range(n):
            c = [[(x + rnd.uniform(-jitter, jitter), y + rnd.uniform(-jitter, jitter), True) for x, y, _ in box(0, 0, 800, 900)]]
            rows.append((f"g{g}", f"{rnd.getrandbits(40):010x}", c))
    rows += [("shape", "a", [box(0, 0, 9, 9)]), ("shape", "b", [box(0, 0, 9, 9)[:3]]), ("shape", "c", [box(0, 0, 9, 9)])]
    rows += [("none", v, []) for v in "abc"]
    got = {r["group_id"]: r["min_similarity"] for r in sim.min_geo_similarity(spark.createDataFrame(rows, SCHEMA), cell).collect()}
    want = brute(rows, plain_similarity)
    assert set(got) == set(want)
    for g, scores in want.items():
        assert got[g] == (pytest.approx(min(scores)) if scores else None), g


@pytest.mark.parametrize("seed", range(4))
def test_pivot_bounds_lose_no_pair(spark, seed):
    """Groups around every limit: pairs that are close, harmless and apart, in few and many dimensions."""
    rnd = random.Random(seed)
    rows = []
    for g in range(24):
        jitter, points, n = rnd.choice([0.8, 1.02, 1.2, 1.9, 3, 8, 14]), rnd.choice([1, 2, 4, 9]), rnd.randrange(3, 40)
        base = [(rnd.uniform(0, 900), rnd.uniform(0, 900)) for _ in range(points)]
        drift = rnd.choice([0, 0, 1.0, 4.0])
        for v in range(n):
            dx, dy = rnd.uniform(-drift, drift), rnd.uniform(-drift, drift)
            c = [[(x + dx + rnd.uniform(-jitter, jitter), y + dy + rnd.uniform(-jitter, jitter), True) for x, y in base]]
            rows.append((f"g{g}", f"{rnd.getrandbits(40):010x}", c))
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["group_id"]: r["min_similarity"] for r in sim.min_geo_similarity(frame, 16).collect()}
    want = brute(rows, plain_similarity)
    for g, scores in want.items():
        assert got[g] == pytest.approx(min(scores)), g


def test_pairs_formed_stay_near_linear(spark):
    """100,000 nearly equal outlines, moved a little each: the bounds leave a sliver of 5 billion pairs."""
    from pyspark.sql import functions as F

    n = 100_000
    move = lambda seed: (F.rand(seed) - 0.5) * 5
    corner = lambda x, y: F.struct((F.lit(float(x)) + F.col("dx") + F.rand(x + 7) * 0.01).alias("x"), (F.lit(float(y)) + F.col("dy")).alias("y"))
    rows = (
        spark.range(n)
        .withColumns({"dx": move(1), "dy": move(2)})
        .select(F.lit("g").alias("group_id"), F.hex("id").alias("variant_id"), F.array(*[corner(*p) for p in ((0, 0), (0, 900), (800, 900), (800, 0))]).alias("points"))
    )
    (got,) = sim.farthest_pairs(rows).collect()
    assert got["close"] and 4.9 < got["widest"] <= 5.02
    assert 0 < got["formed"] < 20 * n


def cells_of(outline):
    points = [p for c in outline for p in c]
    raw = sim._fill_all([[p[0] for p in points]], [[p[1] for p in points]], [[p[2] for p in points]], [[len(c) for c in outline]])
    return np.unpackbits(raw[0]).reshape(64, 64)


def test_fill_counts_cells():
    assert cells_of([box(0, 0, 1024, 1024)]).sum() == 64 * 64
    assert cells_of([box(0, 0, 512, 256)]).sum() == 32 * 16
    hole = cells_of([box(0, 0, 1024, 1024), box(256, 256, 768, 768, cw=False)])
    assert hole.sum() == 64 * 64 - 32 * 32
    same_way = cells_of([box(0, 0, 1024, 1024), box(256, 256, 768, 768)])
    assert same_way.sum() == 64 * 64


def test_fill_curves():
    # Four corner controls without drawn points make a near-circle between the edge midpoints.
    circle = [[(x, y, False) for x, y in ((0.0, 0.0), (0.0, 1024.0), (1024.0, 1024.0), (1024.0, 0.0))]]
    grid = cells_of(circle)
    assert grid[32, 0] and grid[0, 32] and not grid[0, 0] and not grid[63, 63]
    assert 0.75 < grid.mean() < 0.92


@pytest.mark.parametrize("cell", [2, 512])
def test_occupancy_equals_all_pairs(spark, cell):
    rnd = random.Random(5)
    rows = [
        (f"g{g}", f"{rnd.getrandbits(40):010x}", [box(0, 0, rnd.randint(200, 1000), rnd.randint(200, 1000))])
        for g, n in enumerate([5, 2, 7, 1])
        for _ in range(n)
    ]
    rows.append(("g1", "zz", []))
    got = {r["group_id"]: r for r in sim.occupancy_similarity(spark.createDataFrame(rows, SCHEMA), cell).collect()}
    want = brute([r for r in rows if r[2]], lambda a, b: float((cells_of(a) == cells_of(b)).mean()))
    for g, scores in want.items():
        r = got[g]
        if not scores:
            assert (r["min_score"], r["max_score"], r["avg_score"], r["pair_count"]) == (0.0, 0.0, 0.0, 0)
            continue
        assert r["pair_count"] == len(scores)
        assert r["min_score"] == pytest.approx(min(scores), abs=6e-5)
        assert r["max_score"] == pytest.approx(max(scores), abs=6e-5)
        assert r["avg_score"] == pytest.approx(sum(scores) / len(scores), abs=6e-5)


def plain_path(points):
    """Vertices of one closed contour, walked point by point."""
    drawn = [i for i, p in enumerate(points) if p[2]]
    n = len(points)
    half = lambda p, q: ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)
    points = points[drawn[0] :] + points[: drawn[0]] if drawn else points
    path, i = ([points[0][:2]], 1) if drawn else ([half(points[-1], points[0])], 0)
    while i < n:
        p, nxt = points[i], points[(i + 1) % n]
        if p[2]:
            path.append(p[:2])
            i += 1
            continue
        on_point = i + 1 < n and nxt[2]
        end, start = nxt[:2] if on_point else half(p, nxt), path[-1]
        for t in [k / 8 for k in range(1, 9)]:
            path.append(tuple((1 - t) * (1 - t) * start[k] + 2 * t * (1 - t) * p[k] + t * t * end[k] for k in (0, 1)))
        i += 2 if on_point else 1
    return path


def plain_cells(outline):
    """Winding number of every cell centre, one edge at a time."""
    turns = np.zeros((64, 64), int)
    for contour in outline:
        path = plain_path(contour) if contour else []
        for (x0, y0), (x1, y1) in zip(path, path[1:] + path[:1], strict=True):
            for row in range(64):
                y = 16 * row + 8
                if (y0 <= y) != (y1 <= y):
                    x = x0 + (y - y0) / (y1 - y0) * (x1 - x0)
                    turns[row, [c for c in range(64) if 16 * c + 8 >= x]] += 1 if y1 > y else -1
    return turns != 0


def test_fill_equals_walked_paths():
    rnd = random.Random(3)
    outlines = [
        [
            [(float(rnd.randint(-50, 1100)), float(rnd.randint(-50, 1100)), rnd.random() < share) for _ in range(rnd.randint(0, 9))]
            for _ in range(rnd.randint(1, 4))
        ]
        for share in (0.0, 0.2, 0.5, 0.8, 1.0)
        for _ in range(30)
    ]
    parts = [[[p[k] for c in o for p in c] for o in outlines] for k in (0, 1, 2)]
    got = np.unpackbits(sim._fill_all(*parts, [[len(c) for c in o] for o in outlines]), axis=1)
    for o, cells in zip(outlines, got, strict=True):
        assert (cells.reshape(64, 64) == plain_cells(o)).all(), o


GRIDS = "group_id string, variant_id string, cells binary, n long"


def grid_rows(group, grids):
    return [(group, f"{i:08d}", np.packbits(g).tobytes(), 1) for i, g in enumerate(np.unique(grids, axis=0))]


@pytest.mark.parametrize("cell", [3, 4096])
def test_extreme_grids_equal_all_pairs(spark, cell):
    """Groups of grids near a middle, far from each other, and in clusters."""
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for g in range(24):
        n, flips = int(rng.integers(2, 40)), [1, 2, 5, 40, 600, 2000][g % 6]
        bases = rng.random((1 + g % 3, 4096)) < 0.4
        grids = np.unique(bases[rng.integers(0, len(bases), n)] ^ (rng.random((n, 4096)) < flips / 4096), axis=0)
        rows += grid_rows(f"a|{g}", grids)
        gaps = [int((p != q).sum()) for i, p in enumerate(grids) for q in grids[:i]]
        equal = [4096 - x for x in gaps]
        want[f"a|{g}"] = (max(gaps), min(gaps), sum(equal)) if gaps else None
    folded = spark.createDataFrame(rows, GRIDS)
    counts = sim.cell_counts(folded, cell)
    sums = {r["group_id"]: r for r in counts.collect()}
    got = {r["group_id"]: r for r in sim.extreme_pairs(folded, counts.select("group_id", "middle"), cell).collect()}
    assert set(got) == {g for g, w in want.items() if w}
    for g, r in got.items():
        n = sums[g]["variants"]
        assert (r["widest"], r["nearest"]) == want[g][:2], g
        assert int(sums[g]["squares"]) - n * sums[g]["filled"] + 4096 * n * (n - 1) // 2 == want[g][2]


def test_grid_pairs_formed_stay_few(spark):
    """20,000 grids a few cells from a common one: the bounds leave a sliver of 200 million pairs."""
    rng = np.random.default_rng(9)
    n = 20_000
    grids = np.repeat(rng.random((1, 4096)) < 0.4, n, axis=0)
    for i in range(n):
        grids[i, rng.integers(0, 4096, 1 + int(rng.geometric(0.3)))] ^= True
    rows = grid_rows("g", grids)
    folded = spark.createDataFrame(rows, GRIDS).repartition(8)
    (got,) = sim.extreme_pairs(folded, sim.cell_counts(folded).select("group_id", "middle")).collect()
    assert got["nearest"] == 1
    assert got["formed"] < 20 * len(rows)


def test_rule_prefers_occupancy_then_geometry(spark):
    rec = spark.createDataFrame(
        [("unicode_conflict", g, 2) for g in "abcde"] + [("glyph_duplicate", "f", 1)], "type string, group_id string, variant_count long"
    )
    geo = spark.createDataFrame([("b", 0.95), ("c", 0.2), ("d", 0.3)], "group_id string, min_similarity double")
    vis = spark.createDataFrame([("a", 0.9), ("b", 0.5), ("c", 0.7)], "group_id string, min_score double")
    got = {r["group_id"]: (r["is_false_positive"], r["similarity_score"], r["similarity_type"]) for r in sim.flag_false_positives(rec, geo, vis).collect()}
    assert got == {
        "a": (True, 0.9, "visual"), "b": (True, 0.95, "geometric"), "c": (False, 0.7, "visual"),
        "d": (False, 0.3, "geometric"), "e": (False, 0.0, "none"), "f": (None, None, None),
    }
    assert {r[0] for r in sim.needs_geometry(rec, vis).collect()} == set("bcde")
