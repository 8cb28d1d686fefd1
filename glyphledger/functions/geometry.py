"""Outline geometry on ``array<array<struct<x,y,on_curve>>>`` with higher-order functions.

Everything here is a column expression, so one projection normalises a glyph
without a shuffle and without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Target units per em and the decimals kept.
TARGET_UPM = 1024
DECIMALS = 4

POINT = "struct<x:double,y:double,on_curve:boolean>"
CONTOURS = f"array<array<{POINT}>>"


def _point(x: Column, y: Column, on: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), on.alias("on_curve"))


def map_points(contours: Column, fx, fy) -> Column:
    return F.transform(
        contours,
        lambda c: F.transform(c, lambda p: _point(fx(p["x"]), fy(p["y"]), p["on_curve"])),
    )


def half_even(v: Column, decimals: int = DECIMALS) -> Column:
    unit = float(10**decimals)
    return F.rint(v * F.lit(unit)) / F.lit(unit)


def scale_factor(upm: Column) -> Column:
    return F.lit(float(TARGET_UPM)) / F.coalesce(upm, F.lit(TARGET_UPM)).cast("double")


def scale(contours: Column, upm: Column) -> Column:
    """Scale to the target units; outlines already there are not touched."""
    k = scale_factor(upm)
    same = F.coalesce(upm, F.lit(TARGET_UPM)) == TARGET_UPM
    return F.when(same, contours).otherwise(
        map_points(contours, lambda x: x * k, lambda y: y * k)
    )


def round_points(contours: Column, decimals: int = DECIMALS) -> Column:
    return map_points(contours, lambda x: half_even(x, decimals), lambda y: half_even(y, decimals))


def _sums(contour: Column) -> Column:
    return F.transform(contour, lambda p: p["x"] + p["y"])


def rotate_start(contour: Column) -> Column:
    """Start at the first point with the smallest x + y."""
    sums = _sums(contour)
    at = F.array_position(sums, F.array_min(sums)).cast("int")
    return F.when(F.size(contour) == 0, contour).otherwise(
        F.concat(
            F.slice(contour, at, F.size(contour) - at + 1), F.slice(contour, F.lit(1), at - 1)
        )
    )


def _axis(contour: Column, axis: str) -> Column:
    return F.transform(contour, lambda p: p[axis])


def bbox(contour: Column) -> Column:
    """Box of one contour; zeros for an empty one."""
    xs, ys = _axis(contour, "x"), _axis(contour, "y")
    zero = F.lit(0.0)
    return F.struct(
        F.coalesce(F.array_min(xs), zero).alias("x0"),
        F.coalesce(F.array_min(ys), zero).alias("y0"),
        F.coalesce(F.array_max(xs), zero).alias("x1"),
        F.coalesce(F.array_max(ys), zero).alias("y1"),
    )


def box_area(contour: Column) -> Column:
    b = bbox(contour)
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def glyph_bbox(contours: Column) -> Column:
    return bbox(F.flatten(contours))


def glyph_box_area(contours: Column) -> Column:
    return F.greatest(F.lit(0.0), box_area(F.flatten(contours)))


def sort_contours(contours: Column) -> Column:
    """Largest box first, then smallest x + y, then the original place."""
    keyed = F.transform(
        contours,
        lambda c, i: F.struct(
            (-box_area(c)).alias("neg_area"),
            F.array_min(_sums(c)).alias("min_xy"),
            i.alias("place"),
            c.alias("contour"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["contour"])


def signed_area(contour: Column) -> Column:
    n = F.size(contour)
    nxt = F.concat(F.slice(contour, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(contour, 1, 1))
    cross = F.zip_with(contour, nxt, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.aggregate(cross, F.lit(0.0), lambda acc, v: acc + v) / F.lit(2.0)


def orient_cw(contour: Column) -> Column:
    return F.when(
        (F.size(contour) >= 3) & (signed_area(contour) > 0), F.reverse(contour)
    ).otherwise(contour)


def canonical_text(contours: Column, decimals: int = DECIMALS) -> Column:
    """One text per outline in integer units of the last kept decimal.

    Integers print alike in every engine; float text does not.
    """
    unit = float(10**decimals)

    def units(v: Column) -> Column:
        return F.rint(v * F.lit(unit)).cast("long").cast("string")

    return F.array_join(
        F.transform(
            contours,
            lambda c: F.array_join(
                F.transform(
                    c,
                    lambda p: F.concat_ws(
                        ",", units(p["x"]), units(p["y"]), F.when(p["on_curve"], "1").otherwise("0")
                    ),
                ),
                ";",
            ),
        ),
        "|",
    )


def flat_arrays(contours: Column) -> list[Column]:
    """x, y, on_curve and contour lengths as flat arrays, the form Arrow hands over without nesting."""
    points = F.flatten(contours)
    return [
        F.transform(points, lambda p: p["x"]),
        F.transform(points, lambda p: p["y"]),
        F.transform(points, lambda p: p["on_curve"]),
        F.transform(contours, lambda c: F.size(c)),
    ]


# Up to here a multiple of the last decimal is the only one its shortest text can stand for.
_EXACT = 1e11


def shortest_text(v: Column, decimals: int = DECIMALS) -> Column:
    """Shortest text that reads back as the same number, for a number rounded to ``decimals``.

    Built from the integer units of the last decimal: ``1.5``, ``-0.0001``, ``7.0``,
    ``-0.0``. Other numbers, far beyond any outline, keep the engine's text.
    """
    plain = v.cast("string")
    units = F.abs(F.rint(v * F.lit(float(10**decimals)))).cast("long")
    whole = F.floor(units / F.lit(10**decimals)).cast("long")
    rest = F.rtrim(F.lpad((units - whole * F.lit(10**decimals)).cast("string"), decimals, "0"), F.lit("0"))
    sign = F.when((v < 0) | (plain == "-0.0"), "-").otherwise("")
    text = F.concat(sign, whole.cast("string"), F.lit("."), F.when(rest == "", "0").otherwise(rest))
    return F.when(F.abs(v) < _EXACT, text).otherwise(plain)


def json_text(contours: Column) -> Column:
    """Compact JSON with sorted keys of contours rounded to ``DECIMALS``."""

    def point(p: Column) -> Column:
        drawn = F.when(p["on_curve"], "true").otherwise("false")
        return F.concat(
            F.lit('{"on_curve":'), drawn, F.lit(',"x":'), shortest_text(p["x"]), F.lit(',"y":'), shortest_text(p["y"]), F.lit("}")
        )

    def listed(parts: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))

    return listed(F.transform(contours, lambda c: listed(F.transform(c, point))))


def json_text_hash(contours: Column) -> Column:
    """Digest over compact sorted-key JSON with shortest float text, for byte parity; an expression like the rest."""
    return F.substring(F.sha2(json_text(contours), 256), 1, 16)


def glyph_hash(contours: Column, compat: bool = False) -> Column:
    """Digest of the clockwise form of normalised contours."""
    oriented = F.transform(contours, orient_cw)
    if compat:
        return json_text_hash(oriented)
    return F.substring(F.sha2(canonical_text(oriented), 256), 1, 16)


def shape_signature(contours: Column) -> Column:
    """Contour lengths in order; two outlines can only be alike if these are equal."""
    return F.array_join(F.transform(contours, lambda c: F.size(c).cast("string")), ",")


def _mean(gaps: Column) -> Column:
    return F.aggregate(gaps, F.lit(0.0), lambda a, v: a + v) / F.size(gaps)


# Fixed values of the geometric comparison.
BOX_AREA_TOLERANCE = 0.05
CLOSE_GAP = 2.0
CLOSE_SCORE = 0.95
GAP_SPAN = 20.0


def geo_similarity(a: Column, b: Column) -> Column:
    """Similarity of two outlines between 0 and 1."""
    area_a, area_b = glyph_box_area(a), glyph_box_area(b)
    larger = F.greatest(area_a, area_b)
    gaps = F.zip_with(
        F.flatten(a),
        F.flatten(b),
        lambda p, q: F.greatest(F.abs(p["x"] - q["x"]), F.abs(p["y"] - q["y"])),
    )
    return (
        F.when(shape_signature(a) != shape_signature(b), 0.0)
        .when((larger > 0) & (F.abs(area_a - area_b) / larger > BOX_AREA_TOLERANCE), 0.0)
        .when(F.size(gaps) == 0, F.when(F.size(a) == 0, 1.0).otherwise(0.0))
        .when(F.array_max(gaps) < CLOSE_GAP, CLOSE_SCORE)
        .otherwise(F.greatest(F.lit(0.0), 1.0 - _mean(gaps) / F.lit(GAP_SPAN)))
    )
