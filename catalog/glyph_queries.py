"""Outline geometry and glyph rows: queries and checks.

Outlines are compared as text in integer units of the fourth decimal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import part, query
from catalog.fixtures import contours, table, view
from glyphledger.functions import geometry as G
from glyphledger.operators import glyphs as gl

part(
    "contour_fx",
    """SELECT vec_id, label, concat('v', vec_id) AS asset_id, CASE WHEN vec_id % 5 = 0 THEN 560 ELSE 1024 END AS upm,
  CASE WHEN vec_id % 50 = 7 THEN 'empty' WHEN vec_id % 50 = 8 THEN 'composite' ELSE 'simple' END AS glyph_type,
  cast(vec_id % 700 AS double) + 0.00005 AS advance_width, cast(vec_id % 13 AS double) AS lsb,
  [[{'x': cast(embedding[k*16+2*i+1] AS double)*1000, 'y': cast(embedding[k*16+2*i+2] AS double)*1000,
     'on_curve': i % 3 <> 2} for i in range(8)] for k in range(4)] AS contours FROM embeddings""",
)


def pts(c: str, f: str) -> str:
    return f"list_transform({c}, lambda c: list_transform(c, lambda p: {f}))"


def rounded(v: str) -> str:
    return f"round_even({v}*10000, 0)/10000"


def sums(c: str) -> str:
    return f"list_transform({c}, lambda p: p.x + p.y)"


def area_of(c: str) -> str:
    return (
        f"((list_max([p.x for p in {c}]) - list_min([p.x for p in {c}])) * "
        f"(list_max([p.y for p in {c}]) - list_min([p.y for p in {c}])))"
    )


def shoelace(c: str) -> str:
    return (
        f"(list_sum(list_transform(range(1, len({c})+1), lambda i: {c}[i].x*{c}[(i % len({c}))+1].y - "
        f"{c}[(i % len({c}))+1].x*{c}[i].y))/2)"
    )


def as_text(cs: str) -> str:
    return (
        f"array_to_string(list_transform({cs}, lambda c: array_to_string(list_transform(c, lambda p: "
        "round_even(p.x*10000, 0)::BIGINT::VARCHAR || ',' || round_even(p.y*10000, 0)::BIGINT::VARCHAR || ',' || "
        "CASE WHEN p.on_curve THEN '1' ELSE '0' END), ';')), '|')"
    )


def oriented(cs: str) -> str:
    return f"list_transform({cs}, lambda c: CASE WHEN len(c) >= 3 AND {shoelace('c')} > 0 THEN list_reverse(c) ELSE c END)"


K = "(CASE WHEN upm = 1024 THEN 1.0::DOUBLE ELSE 1024.0::DOUBLE/upm END)"
part("scaled_fx", f"SELECT * REPLACE ({pts('contours', '{x: p.x*k, y: p.y*k, on_curve: p.on_curve}')} AS contours) FROM (SELECT *, {K} AS k FROM contour_fx)")
part(
    "rounded_fx",
    f"SELECT * REPLACE ({pts('contours', '{x: ' + rounded('p.x') + ', y: ' + rounded('p.y') + ', on_curve: p.on_curve}')} AS contours) FROM scaled_fx",
)
part(
    "started_fx",
    f"""SELECT * REPLACE (list_transform(contours, lambda c: list_concat(
  c[list_position({sums('c')}, list_min({sums('c')})):], c[:list_position({sums('c')}, list_min({sums('c')}))-1])) AS contours) FROM rounded_fx""",
)
part(
    "sorted_fx",
    f"""SELECT * REPLACE (list_transform(list_sort(list_transform(contours, lambda c, i: {{a: -{area_of('c')}, m: list_min({sums('c')}), i: i, c: c}})), lambda s: s.c) AS contours) FROM started_fx""",
)
part(
    "norm_fx",
    f"""SELECT vec_id, asset_id, label, glyph_type, upm, glyph_type <> 'empty' AND upm <> 1024 AS upm_changed,
  CASE WHEN glyph_type <> 'empty' AND upm <> 1024 THEN upm END AS source_upm,
  CASE WHEN glyph_type = 'empty' THEN advance_width ELSE round_even(advance_width*k*10000, 0)/10000 END AS advance_width,
  CASE WHEN glyph_type = 'empty' THEN lsb ELSE round_even(lsb*k*10000, 0)/10000 END AS lsb,
  CASE glyph_type WHEN 'empty' THEN 'empty' WHEN 'simple' THEN substr(sha256({as_text(oriented('contours'))}), 1, 16) END AS glyph_hash,
  glyph_type = 'composite' AS failed FROM sorted_fx""",
)


def _text(df, column):
    return df.select("vec_id", G.canonical_text(column).alias("outline"))


@query("G3", f"SELECT vec_id, {as_text('contours')} AS outline FROM scaled_fx")
def outline_scaling(spark, sf):
    return _text(contours(spark, sf), G.scale(F.col("contours"), F.col("units_per_em")))


@query("G4", f"SELECT vec_id, {as_text('contours')} AS outline FROM rounded_fx")
def outline_rounding(spark, sf):
    return _text(contours(spark, sf), G.round_points(G.scale(F.col("contours"), F.col("units_per_em"))))


@query("G5", f"SELECT vec_id, {as_text('contours')} AS outline FROM started_fx")
def contour_starts(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    return _text(contours(spark, sf), F.transform(points, G.rotate_start))


@query(
    "G6",
    """SELECT vec_id, list_min(xs) AS x0, list_min(ys) AS y0, list_max(xs) AS x1, list_max(ys) AS y1, (list_max(xs)-list_min(xs))*(list_max(ys)-list_min(ys)) AS area
FROM (SELECT vec_id, [p.x for p in flatten(contours)] AS xs, [p.y for p in flatten(contours)] AS ys FROM rounded_fx)""",
)
def outline_boxes(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    return (
        contours(spark, sf)
        .select("vec_id", points.alias("c"))
        .select("vec_id", G.glyph_bbox(F.col("c")).alias("b"), G.glyph_box_area(F.col("c")).alias("area"))
        .select("vec_id", "b.x0", "b.y0", "b.x1", "b.y1", "area")
    )


@query("G7", f"SELECT vec_id, {as_text('contours')} AS outline FROM sorted_fx")
def contour_order(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    return _text(contours(spark, sf), G.sort_contours(F.transform(points, G.rotate_start)))


@query(
    "G8",
    f"SELECT vec_id, unnest(range(4))::INT AS contour_no, round(unnest(list_transform(contours, lambda c: {shoelace('c')})), 4) AS area FROM rounded_fx",
)
def contour_signed_area(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    return (
        contours(spark, sf)
        .select("vec_id", F.posexplode(points).alias("contour_no", "c"))
        .select("vec_id", "contour_no", F.round(G.signed_area(F.col("c")), 4).alias("area"))
    )


@query("G9", f"SELECT vec_id, {as_text(oriented('contours'))} AS outline FROM rounded_fx")
def contour_direction(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    return _text(contours(spark, sf), F.transform(points, G.orient_cw))


@query("G10", f"SELECT vec_id, substr(sha256({as_text(oriented('contours'))}), 1, 16) AS glyph_hash FROM sorted_fx")
def outline_fingerprint(spark, sf):
    points = G.round_points(G.scale(F.col("contours"), F.col("units_per_em")))
    ready = G.sort_contours(F.transform(points, G.rotate_start))
    return contours(spark, sf).select("vec_id", G.glyph_hash(ready).alias("glyph_hash"))


# The engine's own shortest float text, against the text that is built from integer units.
_JSON_POINT = """'{"on_curve":' || p.on_curve::VARCHAR || ',"x":' || p.x::VARCHAR || ',"y":' || p.y::VARCHAR || '}'"""
_JSON = (
    f"""'[' || array_to_string(list_transform({oriented('contours')}, lambda c: """
    f"""'[' || array_to_string(list_transform(c, lambda p: {_JSON_POINT}), ',') || ']'), ',') || ']'"""
)


@query(
    "G10",
    f"""SELECT vec_id, CASE glyph_type WHEN 'empty' THEN 'empty' WHEN 'simple' THEN substr(sha256({_JSON}), 1, 16) END AS glyph_hash FROM sorted_fx""",
)
def outline_fingerprint_json(spark, sf):
    norm = gl.normalize_glyphs(contours(spark, sf), compat=True)
    return norm.select("vec_id", "glyph_hash")


@query(
    "G11",
    "SELECT vec_id, upm_changed, source_upm, advance_width, lsb, glyph_hash, failed FROM norm_fx",
)
def glyph_normalisation(spark, sf):
    return gl.normalize_glyphs(contours(spark, sf)).select(
        "vec_id", "upm_changed", "source_upm", "advance_width", "lsb", "glyph_hash",
        F.col("error").isNotNull().alias("failed"),
    )


@query("G2", "SELECT glyph_type, count(*) AS glyphs FROM glyph_fx GROUP BY 1")
def glyph_type_totals(spark, sf):
    return gl.glyph_type_counts(view(spark, sf, "glyph_fx"))


@query(
    "G2",
    "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'composite' WHEN p_size % 3 > 0 THEN 'simple' ELSE 'empty' END AS glyph_type FROM part",
)
def glyph_classification(spark, sf):
    kind = gl.glyph_type(F.col("p_size") % 3, F.col("p_partkey") % 7 == 0)
    return table(spark, sf, "part").select("p_partkey", kind.alias("glyph_type"))


@query(
    "G12",
    """SELECT count(*) FILTER (NOT failed) AS total, count(*) FILTER (NOT failed AND upm_changed) AS scaled, count(*) FILTER (NOT failed AND NOT upm_changed) AS unchanged,
  count(*) FILTER (glyph_type = 'empty') AS empty, count(*) FILTER (failed) AS errors, count(DISTINCT glyph_hash) FILTER (glyph_hash <> 'empty') AS distinct_hashes FROM norm_fx""",
)
def normalisation_summary(spark, sf):
    return gl.norm_summary(gl.normalize_glyphs(contours(spark, sf)))


@query(
    "G12",
    """SELECT concat('l', label) AS asset_id, count(*) FILTER (NOT failed) AS total, count(*) FILTER (upm_changed AND NOT failed) AS scaled FROM norm_fx
GROUP BY 1 HAVING count(*) FILTER (upm_changed AND NOT failed) > 0""",
)
def normalisation_by_asset(spark, sf):
    by_label = F.concat(F.lit("l"), F.col("label").cast("string"))
    return gl.norm_summary_by_asset(
        gl.normalize_glyphs(contours(spark, sf)).withColumn("asset_id", by_label)
    )


part(
    "extraction_out",
    """SELECT a.asset_id, coalesce(n, 0) AS num_glyphs, units_per_em, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status
FROM asset_fx a LEFT JOIN (SELECT asset_id, count(*) AS n FROM glyph_fx GROUP BY 1) g ON g.asset_id = a.asset_id WHERE download_status = 'ok'""",
)


def _extraction(spark, sf):
    assets = view(spark, sf, "asset_fx")
    return gl.extraction_summary(
        view(spark, sf, "glyph_fx"), assets, assets.select("asset_id", "units_per_em")
    )


@query("V4", "SELECT * FROM extraction_out")
def extraction_by_asset(spark, sf):
    return _extraction(spark, sf)


@query(
    "V4",
    """SELECT count(*) AS total_assets, sum(num_glyphs)::BIGINT AS total_glyphs, count(*) FILTER (status = 'ok') AS ok,
  count(*) FILTER (status = 'error') AS error FROM extraction_out""",
)
def extraction_totals(spark, sf):
    return gl.extraction_totals(_extraction(spark, sf))


@query(
    "V5",
    """SELECT asset_id, num_glyphs, units_per_em, CASE WHEN units_per_em NOT IN (512,1000,1024,2048,4096) OR num_glyphs < 1 THEN 'warning' ELSE 'ok' END AS status
FROM extraction_out""",
)
def unit_check(spark, sf):
    return gl.check_units(_extraction(spark, sf).drop("status"))


@query("V5", "SELECT units_per_em, count(*) AS assets FROM asset_fx GROUP BY 1")
def units_seen(spark, sf):
    return gl.units_seen(view(spark, sf, "asset_fx"))


