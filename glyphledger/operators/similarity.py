"""Likeness of the variants of a conflict, and false positives.

The rule needs the least alike pair of each group. Cheap aggregates settle most
groups: different shapes or box areas give 0, two variants are compared
directly, and one comparison with the first variant settles groups that are far
apart or very close. Only what is left is compared pair by pair, in square
cells of bounded size that return one row each, so neither pairs nor groups are
ever collected.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphledger.functions import geometry as G
from glyphledger.operators.conflicts import CODE_CONFLICT, NAME_CONFLICT
from glyphledger.session import materialize

# Limits of the two similarity tests, grid size, score thresholds.
VISUAL_MIN = 0.90
GEOMETRIC_MIN = 0.9
GRID = 64
CURVE_STEPS = 8
SCORE_STEPS = (0.99, 0.95, 0.9, 0.85, 0.8, 0.7, 0.5)

CELL = 4096  # variants in a strip: a cell takes two of them, 4 MB of grids or outlines
_ROWS = 256  # rows of a cell compared at once


def outlines_by_asset(glyphs: DataFrame) -> DataFrame:
    """Outline of each (fingerprint, asset): the last row wins, the first row gives the order."""
    return glyphs.groupBy("glyph_hash", "asset_id").agg(
        F.max_by(F.struct("contours", "advance_width", "glyph_type"), "ord").alias("outline"),
        F.min("ord").alias("first_ord"),
    )


def variant_geometry(
    hashes: DataFrame, sources: DataFrame, by_asset: DataFrame, fallback: bool = True
) -> DataFrame:
    """(glyph_hash, outline, found_by): the first source that has an outline, else any row.

    The outlines are read and grouped once; rows of no source have no place and count for ``any`` only.
    """
    placed = by_asset.join(
        sources.select("glyph_hash", "asset_id", "src_ord"), ["glyph_hash", "asset_id"], "left" if fallback else "inner"
    )
    anyone = F.min_by("outline", "first_ord") if fallback else F.first(F.when(F.lit(False), F.col("outline")))
    best = placed.groupBy("glyph_hash").agg(F.min_by("outline", "src_ord").alias("outline"), anyone.alias("any"))
    return hashes.select("glyph_hash").join(best, "glyph_hash", "left").select(
        "glyph_hash",
        F.coalesce("outline", "any").alias("outline"),
        F.when(F.col("outline").isNotNull(), "source")
        .when(F.col("any").isNotNull(), "hash")
        .alias("found_by"),
    )


def pair_counts(variants: DataFrame) -> DataFrame:
    """Unordered pairs per group, counted without forming them."""
    n = F.col("variants")
    return (
        variants.groupBy("group_id")
        .agg(F.count(F.lit(1)).alias("variants"))
        .withColumn("pairs", (n * (n - 1) / 2).cast("long"))
    )


def pairs_in_cells(
    variants: DataFrame,
    compare: Callable[[pd.DataFrame, pd.DataFrame | None], tuple],
    schema: str,
    cell: int = CELL,
) -> DataFrame:
    """Reduce over all unordered pairs of each group, one output row per cell.

    Variants are dealt to strips of about ``cell`` rows by a hash of their id; the
    order is of no matter to what is reduced. A variant goes to one cell per strip
    of its group, so a cell holds two strips and every pair meets exactly once.
    ``compare`` gets two strips, or one strip and None for the pairs inside it.
    Comparisons in a group are quadratic in its distinct variants, but spread over
    all cells; copies move once per ``cell`` of them.
    """
    sizes = variants.groupBy("group_id").agg(F.count(F.lit(1)).alias("_n"))
    strips = F.ceil(F.col("_n") / cell).cast("int")
    spread = (
        variants.join(sizes, "group_id")
        .withColumn("_strip", F.pmod(F.xxhash64("variant_id"), strips).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), strips - 1)))
        .withColumn("_lo", F.least("_strip", "_other"))
        .withColumn("_hi", F.greatest("_strip", "_other"))
    )

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        group, lo, hi = key
        left = pdf[pdf["_strip"] == lo]
        right = None if lo == hi else pdf[pdf["_strip"] == hi]
        return pd.DataFrame([(group, *compare(left, right))])

    return spread.groupBy("group_id", "_lo", "_hi").applyInPandas(run, f"group_id string, {schema}")


_SLACK = 1e-9  # of a bound, for rounding in sums


def _gaps(a: Column, b: Column) -> Column:
    """Gap of each point of two outlines of the same shape; a metric, and so are its mean and its maximum."""
    return F.zip_with(a, b, lambda p, q: F.greatest(F.abs(p["x"] - q["x"]), F.abs(p["y"] - q["y"])))


def _mean_gap(gaps: Column) -> Column:
    return F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v) / F.size(gaps)


def _midpoint(a: Column, b: Column) -> Column:
    half = lambda k: lambda p, q: ((p[k] + q[k]) / 2)
    return F.zip_with(a, b, lambda p, q: F.struct(half("x")(p, q).alias("x"), half("y")(p, q).alias("y")))


def _moved(points: Column, middle: Column) -> Column:
    """Struct (sx, sy, rest): how far an outline is moved from a point as a whole, and its mean gap beyond that."""
    steps = F.zip_with(points, middle, lambda p, q: F.struct((p["x"] - q["x"]).alias("x"), (p["y"] - q["y"]).alias("y")))
    mean = lambda k: F.aggregate(steps, F.lit(0.0), lambda s, v: s + v[k]) / F.size(steps)
    moved = F.transform(F.array(F.struct(mean("x").alias("x"), mean("y").alias("y"))), lambda m: F.struct(
        m["x"].alias("sx"),
        m["y"].alias("sy"),
        _mean_gap(F.transform(steps, lambda v: F.greatest(F.abs(v["x"] - m["x"]), F.abs(v["y"] - m["y"])))).alias("rest"),
    ))
    return moved[0]


def _pivots(rows: DataFrame) -> DataFrame:
    """(group_id, pivots) of each group: four outlines at its far ends, and the point halfway between two of them.

    Each end is the outline farthest from what was chosen before: one pass a pivot.
    """

    def farthest(chosen: DataFrame, from_: str, name: str) -> DataFrame:
        gap = _mean_gap(_gaps(F.col("points"), F.col(from_)))
        end = (
            rows.join(chosen.select("group_id", from_), "group_id")
            .select("group_id", "variant_id", "points", gap.alias("gap"))
            .groupBy("group_id")
            .agg(F.max_by("points", F.struct("gap", "variant_id")).alias(name))
        )
        return materialize(chosen.join(end, "group_id"))

    chosen = materialize(rows.groupBy("group_id").agg(F.min_by("points", "variant_id").alias("p0")))
    chosen = farthest(farthest(chosen, "p0", "p1"), "p1", "p2").withColumn("middle", _midpoint(F.col("p1"), F.col("p2")))
    chosen = farthest(chosen, "middle", "p3")
    return chosen.select("group_id", F.array("p0", "p1", "p2", "p3", "middle").alias("pivots"))


def _far_cell(left: pd.DataFrame, right: pd.DataFrame | None) -> tuple:
    """Largest mean gap of the pairs of a cell that are not close, above a known one, and how many were formed.

    A pair is formed only if no bound rules it out: its distances to every pivot add
    up to more than the best pair known, and so does the gap of the two moves with
    what each outline differs from its move.
    """
    if left.empty or (right is not None and right.empty):
        return None, 0
    a, da = np.stack(left["coords"]), np.stack(left["far"])
    b, db = (a, da) if right is None else (np.stack(right["coords"]), np.stack(right["far"]))
    # From the outside in: the best pair is met early and rules out the rest.
    order = np.argsort(-db[:, -1], kind="stable")
    moves = np.stack([left[k] for k in ("sx", "sy", "rest")], axis=1)
    others = (moves if right is None else np.stack([right[k] for k in ("sx", "sy", "rest")], axis=1))[order]
    b, db, at = b[order], db[order], order
    best, found, formed = float(left["above"].iloc[0]), None, 0
    for i in np.argsort(-da[:, -1], kind="stable"):
        near = np.searchsorted(-db[:, -1], da[i, -1] - best + _SLACK)
        shift = np.abs(others[:near, :2] - moves[i, :2]).max(axis=1) + others[:near, 2] + moves[i, 2]
        mates = np.flatnonzero(shift > best - _SLACK)
        mates = mates[(da[i] + db[mates]).min(axis=1) > best - _SLACK]
        if right is None:
            mates = mates[at[mates] > i]
        if not len(mates):
            continue
        formed += len(mates)
        gap = np.abs(b[mates] - a[i])
        point = np.maximum(gap[:, 0::2], gap[:, 1::2])
        mean = np.where(point.max(axis=1) < G.CLOSE_GAP, -1.0, point.mean(axis=1))
        if mean.max() > best:
            found = best = float(mean.max())
    return found, formed


def _close_cell(left: pd.DataFrame, right: pd.DataFrame | None) -> tuple:
    """Whether some pair of a cell is close at every point."""
    a = np.stack(left["coords"]) if len(left) else None
    b = a if right is None else np.stack(right["coords"]) if len(right) else None
    if a is None or b is None:
        return (False,)
    for i in range(len(a)):
        others = b[i + 1 :] if right is None else b
        if len(others) and bool((np.abs(others - a[i]).max(axis=1) < G.CLOSE_GAP).any()):
            return (True,)
    return (False,)


def farthest_pairs(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """(group_id, widest, close, formed) over distinct outlines (group_id, variant_id, points) of one shape a group.

    ``widest`` is the largest mean gap of the pairs that are not close at every
    point, null if all are close or none matters; ``close`` whether some pair is;
    ``formed`` how many pairs were compared. The mean gap is a metric, so the
    distances of two outlines to a pivot bound their own from above, and only
    outlines that can beat the widest pair known from the pivots meet at all. Where
    some pair is close, one of a mean gap up to ``(1 - CLOSE_SCORE) * GAP_SPAN``
    cannot score less and counts as beaten too. Exact; the work is linear but for
    what the bounds leave, which is spread over cells.
    """
    rows = materialize(rows)
    ends = _pivots(rows)
    to_each = F.transform("pivots", lambda p: _gaps(F.col("points"), p))
    gaps = materialize(
        rows.join(ends, "group_id")
        .withColumn("gaps", to_each)
        .select(
            "group_id",
            "variant_id",
            F.transform("gaps", _mean_gap).alias("far"),
            F.transform("gaps", F.array_max).alias("wide"),
            _moved(F.col("points"), F.element_at("pivots", -1)).alias("moved"),
        )
    )
    real = F.slice(F.arrays_zip("far", "wide"), 1, 4)
    apart = F.array_max(F.transform(F.filter(real, lambda g: g["wide"] >= G.CLOSE_GAP), lambda g: g["far"]))
    touching = F.exists(real, lambda g: (g["wide"] < G.CLOSE_GAP) & (g["wide"] > 0))
    bounds = gaps.groupBy("group_id").agg(
        F.max(apart).alias("known"),
        F.max(touching).alias("touching"),
        *[F.max(F.col("far")[k]).alias(f"reach{k}") for k in range(5)],
        *[F.max(F.col(f"moved.{k}") + F.col("moved.rest")).alias(f"hi_{k}") for k in ("sx", "sy")],
        *[F.min(F.col(f"moved.{k}") - F.col("moved.rest")).alias(f"lo_{k}") for k in ("sx", "sy")],
    )
    harmless = F.when(F.col("touching"), F.lit((1 - G.CLOSE_SCORE) * G.GAP_SPAN)).otherwise(-1.0)
    bounds = materialize(
        bounds.select(
            "group_id",
            "known",
            "touching",
            F.greatest(F.coalesce("known", F.lit(-1.0)), harmless).alias("above"),
            F.array(*[f"reach{k}" for k in range(5)]).alias("reach"),
            "hi_sx", "lo_sx", "hi_sy", "lo_sy",
        )
    )
    can_beat = F.forall(
        F.zip_with("far", "reach", lambda d, r: d + r), lambda most: most > F.col("above") - _SLACK
    )
    span = F.greatest(
        *[F.abs(F.col(f"{end}_{k}") - F.col(f"moved.{k}")) for end in ("hi", "lo") for k in ("sx", "sy")]
    ) + F.col("moved.rest")
    coords = F.flatten(F.transform("points", lambda p: F.array(p["x"], p["y"])))
    wanted = (
        gaps.join(bounds, "group_id")
        .filter(can_beat & (span > F.col("above") - _SLACK))
        .select("group_id", "variant_id", "far", "above", "moved.*")
    )
    cells = pairs_in_cells(
        rows.join(wanted, ["group_id", "variant_id"]).select(
            "group_id", "variant_id", coords.alias("coords"), "far", "above", "sx", "sy", "rest"
        ),
        _far_cell,
        "widest double, formed long",
        cell,
    )
    met = cells.groupBy("group_id").agg(F.max("widest").alias("better"), F.sum("formed").alias("formed"))
    found = materialize(
        bounds.join(met, "group_id", "left").select(
            "group_id",
            "touching",
            F.greatest("known", "better").alias("widest"),
            F.coalesce("formed", F.lit(0)).cast("long").alias("formed"),
        )
    )
    # A close pair matters only where no other pair scores less; pivots show most of them.
    unsure = found.filter(~F.col("touching") & (F.coalesce("widest", F.lit(0.0)) <= (1 - G.CLOSE_SCORE) * G.GAP_SPAN))
    near = pairs_in_cells(
        rows.join(unsure.select("group_id"), "group_id", "left_semi").select("group_id", "variant_id", coords.alias("coords")),
        _close_cell,
        "close boolean",
        cell,
    )
    close = near.groupBy("group_id").agg(F.max("close").alias("close"))
    return found.join(close, "group_id", "left").select(
        "group_id", "widest", (F.col("touching") | F.coalesce("close", F.lit(False))).alias("close"), "formed"
    )


def min_geo_similarity(variants: DataFrame, cell: int = CELL) -> DataFrame:
    """(group_id, found, min_similarity) over (group_id, variant_id, contours).

    Groups with fewer than two outlines have a null score.
    """
    contours = F.col("contours")
    feats = variants.filter(contours.isNotNull()).select(
        "group_id",
        "variant_id",
        "contours",
        G.shape_signature(contours).alias("shape"),
        G.glyph_box_area(contours).alias("area"),
    )
    groups = feats.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("found"),
        F.min("shape").alias("shape_lo"),
        F.max("shape").alias("shape_hi"),
        F.min("area").alias("area_lo"),
        F.max("area").alias("area_hi"),
        F.min_by("contours", "variant_id").alias("first"),
        F.max_by("contours", "variant_id").alias("last"),
    )
    area_gap = (F.col("area_hi") - F.col("area_lo")) / F.col("area_hi")
    judged = groups.select(
        "group_id",
        "found",
        "first",
        F.when(F.col("found") < 2, F.lit(None).cast("double"))
        .when(F.col("shape_lo") != F.col("shape_hi"), 0.0)
        .when(F.col("shape_hi") == "", 1.0)
        .when((F.col("area_hi") > 0) & (area_gap > G.BOX_AREA_TOLERANCE), 0.0)
        .when(F.col("found") == 2, G.geo_similarity(F.col("first"), F.col("last")))
        .alias("score"),
    )
    # One row per group, read three times below; the outlines are not read again for it.
    groups = materialize(judged)
    settled = F.col("found").isin(0, 1) | F.col("score").isNotNull()

    # Distance of every other variant to the first one; shapes are equal here.
    gaps = F.zip_with(
        F.flatten("contours"),
        F.flatten("first"),
        lambda p, q: F.greatest(F.abs(p["x"] - q["x"]), F.abs(p["y"] - q["y"])),
    )
    open_groups = groups.filter(~settled).select("group_id", "first")
    sweep = (
        feats.select("group_id", "variant_id", "contours")
        .join(open_groups, "group_id")
        .select("group_id", gaps.alias("g"))
        .groupBy("group_id")
        .agg(
            F.max(F.size("g")).alias("points"),
            F.max(F.aggregate("g", F.lit(0.0), lambda s, v: s + v) / F.size("g")).alias("far"),
            F.max(F.array_max("g")).alias("widest"),
        )
        .select(
            "group_id",
            F.when(F.col("points") == 0, 0.0)
            # Some pair is a whole span apart.
            .when(F.col("far") >= G.GAP_SPAN, 0.0)
            # No two variants can be further apart than twice the widest gap.
            .when(2 * F.col("widest") < G.CLOSE_GAP, G.CLOSE_SCORE)
            .alias("sweep_score"),
        )
    )
    swept = materialize(sweep)
    left = swept.filter(F.col("sweep_score").isNull()).select("group_id")
    # Equal outlines fold: a pair of them never scores least in a group left here.
    distinct = (
        feats.join(left, "group_id", "left_semi")
        .select(
            "group_id",
            "variant_id",
            F.transform(F.flatten("contours"), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"),
        )
        .groupBy("group_id", "points")
        .agg(F.min("variant_id").alias("variant_id"))
    )
    ends = farthest_pairs(distinct, cell)
    close = F.when(F.col("close"), F.lit(G.CLOSE_SCORE))
    apart = F.when(F.col("widest").isNotNull(), F.greatest(F.lit(0.0), 1.0 - F.col("widest") / F.lit(G.GAP_SPAN)))
    cells = ends.select("group_id", F.least(close, apart).alias("pair_score"))
    return (
        groups.join(swept, "group_id", "left")
        .join(cells, "group_id", "left")
        .select(
            "group_id",
            "found",
            F.coalesce("score", "sweep_score", "pair_score").alias("min_similarity"),
        )
    )


def _segments(pts: np.ndarray, on: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line segments (from, to, contour) of closed contours of quadratic curves with implied midpoints.

    A curve starts on the drawn point before its control point, or halfway from the
    control point before; it ends on the drawn point after, or halfway to the next
    control point. A control point before the first drawn one curves halfway to it
    and closes straight.
    """
    lens = lens[lens > 0]
    contour = np.repeat(np.arange(len(lens)), lens)
    first = np.cumsum(lens) - lens
    at = np.arange(len(pts))
    before = np.where(at == first[contour], (first + lens - 1)[contour], at - 1)
    after = np.where(at == (first + lens - 1)[contour], first[contour], at + 1)
    drawn = np.flatnonzero(on)
    which, where = np.unique(contour[drawn], return_index=True)
    start = np.full(len(lens), -1)
    start[which] = drawn[where]

    straight = np.flatnonzero(on & on[after])
    bends = np.flatnonzero(~on)
    last = after[bends] == start[contour[bends]]
    halfway = lambda i, j: (pts[i] + pts[j]) / 2
    begin = np.where(on[before[bends], None], pts[before[bends]], halfway(before[bends], bends))
    end = np.where((on[after[bends]] & ~last)[:, None], pts[after[bends]], halfway(bends, after[bends]))
    t = np.linspace(0, 1, CURVE_STEPS + 1)[None, :, None]
    curve = (1 - t) ** 2 * begin[:, None] + 2 * t * (1 - t) * pts[bends][:, None] + t**2 * end[:, None]
    return (
        np.concatenate([pts[straight], curve[:, :-1].reshape(-1, 2), end[last]]),
        np.concatenate([pts[after[straight]], curve[:, 1:].reshape(-1, 2), pts[after[bends[last]]]]),
        np.concatenate([contour[straight], np.repeat(contour[bends], CURVE_STEPS), contour[bends[last]]]),
    )


def _fill_all(xs: list, ys: list, on: list, lens: list) -> np.ndarray:
    """64x64 occupancy of outlines by non-zero winding at cell centres, 512 bytes each."""
    n = len(lens)
    flat = lambda parts, kind: np.concatenate([np.asarray(p, kind) for p in parts])
    pts = np.column_stack([np.round(flat(xs, float), 1), np.round(flat(ys, float), 1)]) / (G.TARGET_UPM / GRID)
    sizes = flat(lens, np.int64)
    owner = np.repeat(np.arange(n), [len(k) for k in lens])[sizes > 0]
    a, b, contour = _segments(pts, flat(on, bool), sizes)
    centres = np.arange(GRID) + 0.5
    up = (a[:, 1, None] <= centres) & (b[:, 1, None] > centres)
    down = (b[:, 1, None] <= centres) & (a[:, 1, None] > centres)
    seg, row = np.nonzero(up | down)
    share = (centres[row] - a[seg, 1]) / (b[seg, 1] - a[seg, 1])
    cross = a[seg, 0] + share * (b[seg, 0] - a[seg, 0])
    col = np.clip(np.ceil(cross - 0.5), 0, GRID).astype(int)
    turns = np.zeros((n, GRID, GRID + 1), dtype=np.int32)
    np.add.at(turns, (owner[contour[seg]], row, col), np.where(up[seg, row], 1, -1))
    filled = np.cumsum(turns, axis=2)[:, :, :GRID] != 0
    return np.packbits(filled.reshape(n, -1), axis=1)


@F.pandas_udf(T.BinaryType())
def _occupancy(xs: pd.Series, ys: pd.Series, on: pd.Series, lens: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(lens), dtype=object)
    some = [i for i, k in enumerate(lens) if k is not None and len(k)]
    for lo in range(0, len(some), _ROWS):
        rows = some[lo : lo + _ROWS]
        grids = _fill_all(*[[column.iloc[i] for i in rows] for column in (xs, ys, on, lens)])
        for i, grid in zip(rows, grids, strict=True):
            out.iloc[i] = grid.tobytes()
    return out


def occupancy(contours: Column) -> Column:
    """Filled cells of an outline as 512 bytes; null for an empty outline."""
    return _occupancy(*G.flat_arrays(contours))


_CELLS = GRID * GRID
_PARTS = 4  # parts of a grid whose differences from the middle are counted apart


def _words(cells: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.uint64).reshape(len(cells), -1)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _differing(cells: pd.Series, others: pd.Series) -> pd.Series:
    """Cells in which two grids differ, for each part of the grid."""
    if cells.empty:
        return pd.Series([], dtype=object)
    counts = np.bitwise_count(_words(cells) ^ _words(others)).reshape(len(cells), _PARTS, -1)
    return pd.Series(list(counts.sum(axis=2, dtype=np.int32)))


@F.pandas_udf(T.BinaryType())
def _packed(bits: pd.Series) -> pd.Series:
    return pd.Series([np.packbits(np.asarray(b, bool)).tobytes() for b in bits], dtype=object)


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda s, v: s + v)


def cell_counts(folded: DataFrame, cell: int = CELL) -> DataFrame:
    """(group_id, variants, filled, squares, middle) over (group_id, variant_id, cells, n).

    ``filled`` adds up the grids that fill each cell and ``squares`` the squares of
    these numbers: all that a sum over pairs needs. ``middle`` has the cells that
    more than half of the grids fill. Pieces of about ``cell`` rows are counted
    first; only groups of several pieces move their counts, one row per grid cell.
    """
    sizes = folded.groupBy("group_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum("n").alias("variants"))
    strips = F.ceil(F.col("_rows") / cell).cast("int")
    dealt = folded.join(sizes, "group_id").select(
        "group_id", "variants", "cells", "n", strips.alias("_strips"), F.pmod(F.xxhash64("variant_id"), strips).alias("_strip")
    )

    def tally(key, pdf: pd.DataFrame) -> pd.DataFrame:
        k = np.zeros(_CELLS, np.int64)
        for lo in range(0, len(pdf), _ROWS):
            rows = pdf.iloc[lo : lo + _ROWS]
            bits = np.unpackbits(_words(rows["cells"]).view(np.uint8), axis=1)
            k += rows["n"].to_numpy() @ bits.astype(np.int64)
        if key[3] > 1:
            return pd.DataFrame([(key[0], key[2], None, None, None, k)])
        # The whole group is here: its counts stay here too.
        squares = Decimal(sum(x * x for x in k.tolist()))
        return pd.DataFrame([(key[0], key[2], int(k.sum()), squares, np.packbits(2 * k > key[2]).tobytes(), None)])

    wide = "decimal(38,0)"
    results = ["group_id", "variants", "filled", "squares", "middle"]
    pieces = materialize(
        dealt.groupBy("group_id", "_strip", "variants", "_strips").applyInPandas(
            tally, f"group_id string, variants long, filled long, squares {wide}, middle binary, counts array<long>"
        )
    )
    added = pieces.filter("counts is not null").select("group_id", "variants", F.posexplode("counts").alias("pos", "k")).groupBy("group_id", "pos").agg(
        F.max("variants").alias("variants"), F.sum("k").alias("k")
    )
    # One row per grid cell: the list has 4,096 members whatever the group holds.
    lists = added.groupBy("group_id").agg(
        F.max("variants").alias("variants"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "k"))), lambda c: c["k"]).alias("counts"),
    )
    square = lambda k: k.cast("decimal(19,0)") * k.cast("decimal(19,0)")
    summed = lists.select(
        "group_id",
        "variants",
        F.aggregate("counts", F.lit(0).cast("long"), lambda s, k: s + k).alias("filled"),
        F.aggregate("counts", F.lit(0).cast(wide), lambda s, k: (s + square(k)).cast(wide)).alias("squares"),
        _packed(F.transform("counts", lambda k: 2 * k > F.col("variants"))).alias("middle"),
    )
    return pieces.filter("counts is null").select(*results).unionByName(summed)


def _unlike_cell(left: pd.DataFrame, right: pd.DataFrame | None) -> tuple:
    """Most cells in which a pair differs, above a number known, and how many pairs were formed."""
    if left.empty or (right is not None and right.empty):
        return None, 0
    other = left if right is None else right
    a, da = _words(left["cells"]), np.stack(left["far"])
    order = np.argsort(-np.stack(other["far"])[:, 0], kind="stable")
    b, db = _words(other["cells"])[order], np.stack(other["far"])[order]
    best, found, formed = int(left["above"].iloc[0]), None, 0
    for i in np.argsort(-da[:, 0], kind="stable"):
        near = np.searchsorted(-db[:, 0], da[i, 0] - best)
        mates = np.flatnonzero((da[i] + db[:near]).min(axis=1) > best)
        if right is None:
            mates = mates[order[mates] > i]
        if len(mates):
            formed += len(mates)
            most = int(np.bitwise_count(b[mates] ^ a[i]).sum(axis=1, dtype=np.int64).max())
            if most > best:
                found = best = most
    return found, formed


def _alike_cell(left: pd.DataFrame, right: pd.DataFrame | None) -> tuple:
    """Fewest cells in which a pair differs, below a number known, and how many pairs were formed."""
    if left.empty or (right is not None and right.empty):
        return None, 0
    other = left if right is None else right
    a, pa = _words(left["cells"]), np.stack(left["parts"])
    sums = np.stack(other["parts"]).sum(axis=1)
    order = np.argsort(sums, kind="stable")
    b, pb, sums = _words(other["cells"])[order], np.stack(other["parts"])[order], sums[order]
    best, found, formed = int(left["below"].iloc[0]), None, 0
    for i in range(len(a)):
        lo, hi = np.searchsorted(sums, [pa[i].sum() - best + 1, pa[i].sum() + best])
        mates = lo + np.flatnonzero(np.abs(pb[lo:hi] - pa[i]).sum(axis=1) < best)
        if right is None:
            mates = mates[order[mates] > i]
        if len(mates):
            formed += len(mates)
            least = int(np.bitwise_count(b[mates] ^ a[i]).sum(axis=1, dtype=np.int64).min())
            if least < best:
                found = best = least
    return found, formed


def _neighbours(rows: DataFrame) -> DataFrame:
    """(group_id, gap): cells in which grids differ that stand side by side in one of three sorts of their group."""

    def gaps(batches):
        last = None
        for pdf in batches:
            if pdf.empty:
                continue
            groups, words = (pdf["group_id"] + pdf["sort"].astype(str)).to_numpy(), _words(pdf["cells"])
            names = pdf["group_id"].to_numpy()
            if last is not None:
                groups, words, names = (np.concatenate(p) for p in zip(last, (groups, words, names), strict=True))
            last = groups[-1:], words[-1:], names[-1:]
            same = groups[1:] == groups[:-1]
            gap = np.bitwise_count(words[1:] ^ words[:-1]).sum(axis=1, dtype=np.int64)
            found = pd.DataFrame({"group_id": names[1:][same], "gap": gap[same]})
            yield found.groupby("group_id", as_index=False)["gap"].min()

    by_part = F.concat(*[F.lpad(F.hex(F.col("parts")[k]), 4, "0") for k in range(_PARTS)])
    keys = F.array(F.hex("cells"), F.reverse(F.hex("cells")), by_part)
    sort = ["group_id", "sort", "at"]
    sorts = rows.select("group_id", "cells", F.posexplode(keys).alias("sort", "at"))
    dealt = sorts.repartitionByRange(*sort).sortWithinPartitions(*sort)
    return dealt.select("group_id", "sort", "cells").mapInPandas(gaps, "group_id string, gap long")


def extreme_pairs(folded: DataFrame, middles: DataFrame, cell: int = CELL) -> DataFrame:
    """(group_id, widest, nearest, formed): cells in which the least and the most alike pair of grids differ.

    ``folded`` has distinct grids (group_id, variant_id, cells), ``middles`` a grid
    (group_id, middle) for every group. The number of differing cells is a metric.
    Its largest value is bounded by the distances to the middle and to two far ends;
    only grids that can beat the widest pair known meet. Grids side by side in three
    sorts bound its smallest value by some ``r``. The distances to the middle within
    parts of the grid then differ by less than ``r`` in a nearer pair, so grids meet
    in boxes of that width over two halves, a pair at the larger of its corners; where
    ``r`` is 1 no pair can be nearer. Exact. What the bounds leave is compared in cells of bounded
    size; it is quadratic for grids whose parts all lie at the same distances.
    """
    several = folded.groupBy("group_id").agg(F.count(F.lit(1)).alias("grids")).filter("grids > 1").select("group_id")
    rows = materialize(
        folded.join(several, "group_id")
        .join(middles, "group_id")
        .select("group_id", "variant_id", "cells", _differing(F.col("cells"), F.col("middle")).alias("parts"))
        .withColumn("far0", _total(F.col("parts")))
    )
    for k in (1, 2):
        end = rows.groupBy("group_id").agg(F.max_by("cells", F.struct(f"far{k - 1}", "variant_id")).alias("end"))
        rows = materialize(
            rows.join(end, "group_id")
            .withColumn(f"far{k}", _total(_differing(F.col("cells"), F.col("end"))))
            .drop("end")
        )
    ends = rows.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("grids"),
        F.max(F.greatest("far1", "far2")).cast("long").alias("above"),
        F.min(F.least(F.nullif("far1", F.lit(0)), F.nullif("far2", F.lit(0)))).cast("long").alias("beside"),
        *[F.max(f"far{k}").alias(f"reach{k}") for k in range(3)],
    )
    side = _neighbours(rows).groupBy("group_id").agg(F.min("gap").alias("gap"))
    bounds = materialize(ends.join(side, "group_id", "left").withColumn("below", F.least("beside", "gap")))

    can_beat = [F.col(f"far{k}") + F.col(f"reach{k}") > F.col("above") for k in range(3)]
    wanted = rows.join(bounds, "group_id").filter(can_beat[0] & can_beat[1] & can_beat[2])
    unlike = pairs_in_cells(
        wanted.select("group_id", "variant_id", "cells", F.array("far0", "far1", "far2").alias("far"), "above"),
        _unlike_cell,
        "widest long, formed long",
        cell,
    )
    # A group of few grids is one box: its comparisons are bounded, and copies in four boxes cost more.
    few = F.col("grids") <= cell // 4
    near = rows.join(bounds.filter("below > 1"), "group_id")
    corner = F.when(few, F.array(F.lit(None).cast("long"))).otherwise(F.array(F.lit(0), F.lit(1)))
    halves = [F.floor((F.col("parts")[k] + F.col("parts")[k + 1]) / F.col("below")) for k in (0, 2)]
    named = F.concat_ws(",", *[(half + F.col(c)).cast("string") for half, c in zip(halves, "xy", strict=True)])
    # The group follows the first bar, whatever it holds itself.
    boxes = materialize(
        near.withColumn("x", F.explode(corner))
        .withColumn("y", F.explode(corner))
        .select(F.concat(named, F.lit("|"), F.col("group_id")).alias("box"), "group_id", "variant_id", "below")
    )
    shared = boxes.groupBy("box").agg(F.count(F.lit(1)).alias("grids")).filter("grids > 1").select("box")
    met = boxes.join(shared, "box").join(rows.select("group_id", "variant_id", "cells", "parts"), ["group_id", "variant_id"])
    alike = pairs_in_cells(
        met.select(F.col("box").alias("group_id"), "variant_id", "cells", "parts", "below"),
        _alike_cell,
        "nearest long, formed long",
        cell,
    ).withColumn("group_id", F.expr("substring(group_id, instr(group_id, '|') + 1)"))
    found = (
        unlike.withColumn("nearest", F.lit(None).cast("long"))
        .unionByName(alike.withColumn("widest", F.lit(None).cast("long")))
        .groupBy("group_id")
        .agg(F.max("widest").alias("wider"), F.min("nearest").alias("nearer"), F.sum("formed").alias("formed"))
    )
    return bounds.join(found, "group_id", "left").select(
        "group_id",
        F.greatest("above", "wider").alias("widest"),
        F.least("below", "nearer").alias("nearest"),
        F.coalesce("formed", F.lit(0)).cast("long").alias("formed"),
    )


def occupancy_similarity(variants: DataFrame, cell: int = CELL) -> DataFrame:
    """Min, max and mean share of equal grid cells over the pairs of each group.

    The mean follows from how many grids fill each cell, without pairs. Variants
    with the same grid fold into one row with a count; the extremes of the others
    come from ``extreme_pairs``.
    """
    folded = materialize(
        variants.filter(F.size("contours") > 0)
        .select("group_id", "variant_id", occupancy(F.col("contours")).alias("cells"))
        .groupBy("group_id", "cells")
        .agg(F.count(F.lit(1)).alias("n"), F.min("variant_id").alias("variant_id"))
    )
    counts = materialize(cell_counts(folded, cell))
    ends = extreme_pairs(folded, counts.select("group_id", "middle"), cell)
    pair_n = lambda c: F.floor(c * (c - 1) / 2).cast("long")
    twins = folded.groupBy("group_id").agg((F.max("n") > 1).alias("twins"))
    n = F.col("variants").cast("decimal(19,0)")
    # Grids that both fill a cell or both leave it: C(k, 2) + C(n - k, 2), summed over the cells.
    equal = F.col("squares") - n * F.col("filled").cast("decimal(19,0)") + F.col("pairs").cast("decimal(25,0)") * F.lit(_CELLS)
    known = (
        counts.join(twins, "group_id")
        .join(ends, "group_id", "left")
        .withColumn("pairs", pair_n(F.col("variants")))
        .select(
            "group_id",
            "pairs",
            (F.lit(_CELLS) - F.coalesce("widest", F.when(F.col("twins"), 0))).alias("lo"),
            (F.lit(_CELLS) - F.when(F.col("twins"), 0).otherwise(F.col("nearest"))).alias("hi"),
            equal.cast("double").alias("total"),
        )
    )
    share = lambda c: F.coalesce(F.round(c / F.lit(float(_CELLS)), 4), F.lit(0.0))
    return (
        variants.select("group_id")
        .distinct()
        .join(known, "group_id", "left")
        .select(
            "group_id",
            share(F.col("lo")).alias("min_score"),
            share(F.col("hi")).alias("max_score"),
            share(F.col("total") / F.nullif(F.col("pairs"), F.lit(0))).alias("avg_score"),
            F.coalesce("pairs", F.lit(0)).alias("pair_count"),
        )
    )


def needs_geometry(records: DataFrame, visual: DataFrame | None) -> DataFrame:
    """Groups whose occupancy score is missing or too low to decide."""
    pairs = records.filter(
        F.col("type").isin(CODE_CONFLICT, NAME_CONFLICT) & (F.col("variant_count") >= 2)
    ).select("group_id")
    if visual is None:
        return pairs
    enough = visual.filter(F.col("min_score") >= VISUAL_MIN)
    return pairs.join(enough, "group_id", "left_anti")


def flag_false_positives(
    records: DataFrame, geometric: DataFrame, visual: DataFrame | None = None
) -> DataFrame:
    """Add is_false_positive, similarity_score, similarity_type and recommendation."""
    geo = geometric.select("group_id", F.col("min_similarity").alias("_geo"))
    joined = records.join(geo, "group_id", "left")
    if visual is None:
        joined = joined.withColumn("_vis", F.lit(None).cast("double"))
    else:
        joined = joined.join(visual.select("group_id", F.col("min_score").alias("_vis")), "group_id", "left")
    judged = F.col("type").isin(CODE_CONFLICT, NAME_CONFLICT) & (F.col("variant_count") >= 2)
    by_vis = F.coalesce(F.col("_vis") >= VISUAL_MIN, F.lit(False))
    by_geo = F.coalesce(F.col("_geo") >= GEOMETRIC_MIN, F.lit(False))
    score = F.when(by_vis, F.col("_vis")).when(by_geo, F.col("_geo")).otherwise(
        F.coalesce("_vis", "_geo", F.lit(0.0))
    )
    kind = (
        F.when(by_vis, "visual")
        .when(by_geo, "geometric")
        .when(F.col("_vis").isNotNull(), "visual")
        .when(F.col("_geo").isNotNull(), "geometric")
        .otherwise("none")
    )
    return joined.withColumns(
        {
            "is_false_positive": F.when(judged, by_vis | by_geo),
            "similarity_score": F.when(judged, F.round(score, 4)),
            "similarity_type": F.when(judged, kind),
            "recommendation": F.when(judged & (by_vis | by_geo), "merge_as_same_glyph"),
        }
    ).drop("_geo", "_vis")


def score_distribution(scores: DataFrame) -> DataFrame:
    """How many groups reach each threshold with their best pair; one pass over the scores."""
    counted = scores.agg(
        *[F.count_if(F.col("max_score") >= t).alias(f"n{i}") for i, t in enumerate(SCORE_STEPS)]
    )
    steps = F.array(
        *[
            F.struct(F.lit(t).alias("threshold"), F.col(f"n{i}").alias("groups"))
            for i, t in enumerate(SCORE_STEPS)
        ]
    )
    return counted.select(F.inline(steps))
