"""Similarity, allocation, resolution and registry rewrites: queries and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import part, query
from catalog.fixtures import table, variants_by_label, world
from catalog.glyph_queries import area_of
from glyphledger.functions import geometry as G
from glyphledger.operators import allocation as al
from glyphledger.operators import conflicts as cf
from glyphledger.operators import resolution as rs
from glyphledger.operators import rewrites as rw
from glyphledger.operators import similarity as sim
from glyphledger.session import materialize, scratch_path
from glyphledger.sources.records import registry_current

# A range that is large enough for the largest test folder.
LO, HI = 0xE000, 0xFFFFD

# ---------------------------------------------------------------- similarity

part(
    "by_asset_fx",
    "SELECT glyph_hash, asset_id, arg_max(advance_width, rn) AS adv, arg_max(has_outline, rn) AS outline, min(rn) AS first_rn FROM glyph_fx GROUP BY 1, 2",
)


@query(
    "F1",
    """WITH known AS (SELECT s.* FROM source_fx s JOIN asset_fx a ON a.asset_id = s.asset_id WHERE error IS NOT NULL),
hit AS (SELECT k.glyph_hash, arg_min(adv, src_rn) AS adv FROM known k JOIN by_asset_fx b ON b.glyph_hash = k.glyph_hash AND b.asset_id = k.asset_id GROUP BY 1),
any_row AS (SELECT glyph_hash, arg_min(adv, first_rn) AS adv FROM by_asset_fx GROUP BY 1)
SELECT e.glyph_hash, coalesce(h.adv, r.adv) AS advance_width, CASE WHEN h.glyph_hash IS NOT NULL THEN 'source' ELSE 'hash' END AS found_by
FROM entry_fx e LEFT JOIN hit h ON h.glyph_hash = e.glyph_hash LEFT JOIN any_row r ON r.glyph_hash = e.glyph_hash""",
)
def variant_geometry(spark, sf):
    w = world(spark, sf)
    broken = w.assets.filter(F.col("error").isNotNull()).select("asset_id")
    known = w.reg.sources.join(broken, "asset_id", "left_semi")
    found = sim.variant_geometry(w.reg.entries, known, sim.outlines_by_asset(w.glyphs))
    return found.select("glyph_hash", F.col("outline.advance_width").alias("advance_width"), "found_by")


JIT = "(CASE label % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 6.0 WHEN 2 THEN 30.0 ELSE 400.0 END)::DOUBLE"
part(
    "pair_fx",
    f"""SELECT 'g' || label || '-' || (vec_id % 4) AS group_id, lpad(vec_id::VARCHAR, 12, '0') AS variant_id,
  [[{{'x': (200.0::DOUBLE*k + CASE WHEN i IN (1,2,3,4) THEN 150.0::DOUBLE ELSE 0.0::DOUBLE END) + embedding[k*16+2*i+1]::DOUBLE*{JIT},
     'y': CASE WHEN i IN (3,4,5,6) THEN 700.0::DOUBLE ELSE 0.0::DOUBLE END + embedding[k*16+2*i+2]::DOUBLE*{JIT}}} for i in range(8)]
   for k in range(CASE WHEN label = 9 AND vec_id % 11 = 0 THEN 3 ELSE 4 END)] AS contours FROM embeddings""",
)
part(
    "flat_fx",
    f"SELECT group_id, variant_id, len(contours) AS nc, flatten(contours) AS pts, {area_of('flatten(contours)')} AS area FROM pair_fx",
)


def geo_sql(a: str, b: str) -> str:
    gaps = f"list_transform(range(1, len({a}.pts)+1), lambda i: greatest(abs({a}.pts[i].x - {b}.pts[i].x), abs({a}.pts[i].y - {b}.pts[i].y)))"
    return f"""CASE WHEN {a}.nc <> {b}.nc THEN 0.0 WHEN greatest({a}.area, {b}.area) > 0 AND abs({a}.area - {b}.area)/greatest({a}.area, {b}.area) > 0.05 THEN 0.0
  WHEN list_max({gaps}) < 2.0 THEN 0.95 ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - list_sum({gaps})/len({a}.pts)/20.0::DOUBLE) END"""


part(
    "least_fx",
    f"""SELECT group_id, count(*) AS pairs, min({geo_sql('a', 'b')}) AS least FROM flat_fx a JOIN flat_fx b USING (group_id)
WHERE a.variant_id < b.variant_id GROUP BY 1""",
)


@query(
    "F2",
    "SELECT group_id, (SELECT count(*) FROM pair_fx p WHERE p.group_id = l.group_id) AS variants, pairs FROM least_fx l",
)
def pair_counts(spark, sf):
    return sim.pair_counts(variants_by_label(spark, sf))


@query(
    "F3",
    f"""SELECT b.group_id, b.variant_id, round({geo_sql('a', 'b')}, 6) AS similarity FROM flat_fx b
JOIN (SELECT f.* FROM flat_fx f JOIN (SELECT group_id, min(variant_id) AS variant_id FROM flat_fx GROUP BY 1) m USING (group_id, variant_id)) a ON a.group_id = b.group_id""",
)
def similarity_to_first(spark, sf):
    v = variants_by_label(spark, sf)
    first = v.groupBy("group_id").agg(F.min_by("contours", "variant_id").alias("first"))
    score = F.round(G.geo_similarity(F.col("first"), F.col("contours")), 6)
    return v.join(first, "group_id").select("group_id", "variant_id", score.alias("similarity"))


@query("F3 F5", "SELECT group_id, round(least, 6) AS min_similarity FROM least_fx")
def least_alike_pair(spark, sf):
    least = sim.min_geo_similarity(variants_by_label(spark, sf))
    return least.select("group_id", F.round("min_similarity", 6).alias("min_similarity"))


# Filling of curved outlines: line segments, their crossings with the rows of cell centres, winding numbers, grids as bits.
part(
    "curve_point_fx",
    """SELECT group_id, variant_id, k, i, i % 3 <> 2 AS on_curve, round_even(p.x * 10, 0) / 10 / 16 AS x, round_even(p.y * 10, 0) / 10 / 16 AS y FROM (
  SELECT group_id, variant_id, k, unnest(c) AS p, unnest(range(len(c))) AS i FROM (
    SELECT group_id, variant_id, unnest(contours) AS c, unnest(range(len(contours))) AS k FROM pair_fx))""",
)
part(
    "curve_edge_fx",
    """WITH ring AS (SELECT p.*, b.on_curve AS on_before, b.x AS xb, b.y AS yb, a.on_curve AS on_after, a.x AS xa, a.y AS ya FROM curve_point_fx p
  JOIN curve_point_fx b ON b.variant_id = p.variant_id AND b.k = p.k AND b.i = (p.i + 7) % 8
  JOIN curve_point_fx a ON a.variant_id = p.variant_id AND a.k = p.k AND a.i = (p.i + 1) % 8),
bend AS (SELECT group_id, variant_id, x, y, CASE WHEN on_before THEN xb ELSE (xb + x) / 2 END AS sx, CASE WHEN on_before THEN yb ELSE (yb + y) / 2 END AS sy,
    CASE WHEN on_after THEN xa ELSE (x + xa) / 2 END AS ex, CASE WHEN on_after THEN ya ELSE (y + ya) / 2 END AS ey FROM ring WHERE NOT on_curve),
step AS (SELECT *, j / 8::DOUBLE AS t, (j + 1) / 8::DOUBLE AS u FROM bend, range(8) r(j))
SELECT group_id, variant_id, x AS x0, y AS y0, xa AS x1, ya AS y1 FROM ring WHERE on_curve AND on_after
UNION ALL SELECT group_id, variant_id, (1-t)*(1-t)*sx + 2*t*(1-t)*x + t*t*ex, (1-t)*(1-t)*sy + 2*t*(1-t)*y + t*t*ey,
  (1-u)*(1-u)*sx + 2*u*(1-u)*x + u*u*ex, (1-u)*(1-u)*sy + 2*u*(1-u)*y + u*u*ey FROM step""",
)
part(
    "curve_grid_fx",
    """WITH crossing AS (SELECT group_id, variant_id, r, greatest(0, least(64, ceil(x0 + (r + 0.5::DOUBLE - y0) / (y1 - y0) * (x1 - x0) - 0.5::DOUBLE)))::BIGINT AS c,
    CASE WHEN y1 > r + 0.5::DOUBLE THEN 1 ELSE -1 END AS turn
  FROM curve_edge_fx, range(64) t(r) WHERE (y0 <= r + 0.5::DOUBLE) <> (y1 <= r + 0.5::DOUBLE)),
turned AS (SELECT variant_id, r, c, sum(turn) AS turn FROM crossing GROUP BY 1, 2, 3),
wound AS (SELECT v.group_id, v.variant_id, rr.r, cc.c, sum(coalesce(turn, 0)) OVER (PARTITION BY v.variant_id, rr.r ORDER BY cc.c) AS turns
  FROM pair_fx v CROSS JOIN range(64) rr(r) CROSS JOIN range(64) cc(c) LEFT JOIN turned t ON t.variant_id = v.variant_id AND t.r = rr.r AND t.c = cc.c)
SELECT group_id, variant_id, string_agg(CASE WHEN turns <> 0 THEN '1' ELSE '0' END, '' ORDER BY r, c)::BIT AS grid FROM wound GROUP BY 1, 2""",
)
part(
    "curve_score_fx",
    """SELECT g.group_id, coalesce(round(lo / 4096.0::DOUBLE, 4), 0) AS min_score, coalesce(round(hi / 4096.0::DOUBLE, 4), 0) AS max_score,
  coalesce(round(mean / 4096.0::DOUBLE, 4), 0) AS avg_score, coalesce(n, 0) AS pair_count
FROM (SELECT DISTINCT group_id FROM pair_fx) g LEFT JOIN (
  SELECT group_id, min(same) AS lo, max(same) AS hi, sum(same)::DOUBLE / count(*) AS mean, count(*) AS n FROM (
    SELECT a.group_id, 4096 - bit_count(xor(a.grid, b.grid)) AS same
    FROM curve_grid_fx a JOIN curve_grid_fx b ON a.group_id = b.group_id AND a.variant_id < b.variant_id) GROUP BY 1) s ON s.group_id = g.group_id""",
)


@query("F4", "SELECT * FROM curve_score_fx")
def occupancy_scores(spark, sf):
    return sim.occupancy_similarity(variants_by_label(spark, sf))


def _label_records(spark, sf):
    return sim.pair_counts(variants_by_label(spark, sf)).select(
        F.lit(cf.CODE_CONFLICT).alias("type"), "group_id", F.col("variants").alias("variant_count")
    )


@query(
    "F5",
    """SELECT group_id, least >= 0.9 AS is_false_positive, round(least, 4) AS similarity_score, 'geometric' AS similarity_type,
  CASE WHEN least >= 0.9 THEN 'merge_as_same_glyph' END AS recommendation FROM least_fx""",
)
def false_positives_by_geometry(spark, sf):
    records = _label_records(spark, sf)
    flagged = sim.flag_false_positives(records, sim.min_geo_similarity(variants_by_label(spark, sf)))
    return flagged.drop("type", "variant_count")


@query(
    "F5",
    """SELECT 'unicode_conflict' AS type, c.group_id, (SELECT count(*) FROM pair_fx p WHERE p.group_id = c.group_id) AS variant_count,
  CASE WHEN pairs > 0 THEN min_score >= 0.9 OR least >= 0.9 END AS is_false_positive,
  CASE WHEN pairs > 0 THEN round(CASE WHEN min_score < 0.9 AND least >= 0.9 THEN least ELSE min_score END, 4) END AS similarity_score,
  CASE WHEN pairs > 0 THEN CASE WHEN min_score < 0.9 AND least >= 0.9 THEN 'geometric' ELSE 'visual' END END AS similarity_type,
  CASE WHEN pairs > 0 AND (min_score >= 0.9 OR least >= 0.9) THEN 'merge_as_same_glyph' END AS recommendation
FROM curve_score_fx c LEFT JOIN least_fx l ON l.group_id = c.group_id""",
)
def false_positives_by_both(spark, sf):
    records, v = _label_records(spark, sf), variants_by_label(spark, sf)
    visual = materialize(sim.occupancy_similarity(v))
    undecided = sim.needs_geometry(records, visual)
    geometric = sim.min_geo_similarity(v.join(undecided, "group_id", "left_semi"))
    return sim.flag_false_positives(records, geometric, visual)


# Axis-parallel boxes off the cell centres: their filled cells, and so all scores, have closed forms.
part(
    "box_fx",
    """SELECT group_id, variant_id, c0, c1, r0, r1, (c1 - c0) * (r1 - r0) AS filled FROM (
  SELECT 'b' || label || '-' || (vec_id % 4) AS group_id, vec_id AS variant_id,
    ceil((x0 - 8) / 16)::BIGINT AS c0, ceil((x0 + w - 8) / 16)::BIGINT AS c1, ceil((y0 - 8) / 16)::BIGINT AS r0, ceil((y0 + h - 8) / 16)::BIGINT AS r1
  FROM (SELECT label, vec_id, vec_id * 7919 % jit + 0.3 AS x0, 500 + vec_id * 104729 % jit AS w, vec_id * 1299709 % jit + 0.3 AS y0, 400 + vec_id * 15485863 % jit AS h
    FROM (SELECT label, vec_id, CASE label % 4 WHEN 0 THEN 20 WHEN 1 THEN 60 WHEN 2 THEN 150 ELSE 250 END AS jit FROM embeddings)))""",
)
part(
    "box_score_fx",
    """SELECT g.group_id, coalesce(round(lo / 4096.0::DOUBLE, 4), 0) AS min_score, coalesce(round(hi / 4096.0::DOUBLE, 4), 0) AS max_score,
  coalesce(round(mean / 4096.0::DOUBLE, 4), 0) AS avg_score, coalesce(n, 0) AS pair_count
FROM (SELECT DISTINCT group_id FROM box_fx) g LEFT JOIN (
  SELECT group_id, min(same) AS lo, max(same) AS hi, sum(same)::DOUBLE / count(*) AS mean, count(*) AS n FROM (
    SELECT a.group_id, 4096 - a.filled - b.filled + 2 * greatest(0, least(a.c1, b.c1) - greatest(a.c0, b.c0)) * greatest(0, least(a.r1, b.r1) - greatest(a.r0, b.r0)) AS same
    FROM box_fx a JOIN box_fx b ON a.group_id = b.group_id AND a.variant_id < b.variant_id) GROUP BY 1) s ON s.group_id = g.group_id""",
)


def boxes_by_label(spark, sf):
    """The boxes of the check as outlines of four points."""
    jit = "CASE label % 4 WHEN 0 THEN 20 WHEN 1 THEN 60 WHEN 2 THEN 150 ELSE 250 END"
    sides = table(spark, sf, "embeddings").selectExpr(
        "concat('b', cast(label AS string), '-', cast(vec_id % 4 AS string)) AS group_id",
        "lpad(cast(vec_id AS string), 12, '0') AS variant_id",
        f"cast(vec_id * 7919 % ({jit}) AS double) + 0.3 AS x0",
        f"cast(500 + vec_id * 104729 % ({jit}) AS double) AS w",
        f"cast(vec_id * 1299709 % ({jit}) AS double) + 0.3 AS y0",
        f"cast(400 + vec_id * 15485863 % ({jit}) AS double) AS h",
    )
    point = "named_struct('x', {x}, 'y', {y}, 'on_curve', true)"
    corners = ", ".join(point.format(x=x, y=y) for x, y in (("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h"), ("x0", "y0 + h")))
    return sides.selectExpr("group_id", "variant_id", f"array(array({corners})) AS contours")


@query("F4", "SELECT * FROM box_score_fx")
def occupancy_of_boxes(spark, sf):
    return sim.occupancy_similarity(boxes_by_label(spark, sf))


@query(
    "F5",
    """SELECT group_id, min_score >= 0.9 AS is_false_positive, round(min_score, 4) AS similarity_score, 'visual' AS similarity_type,
  CASE WHEN min_score >= 0.9 THEN 'merge_as_same_glyph' END AS recommendation FROM box_score_fx WHERE min_score >= 0.9""",
)
def boxes_alike_by_sight(spark, sf):
    v = boxes_by_label(spark, sf)
    records = sim.pair_counts(v).select(
        F.lit(cf.CODE_CONFLICT).alias("type"), "group_id", F.col("variants").alias("variant_count")
    )
    visual = materialize(sim.occupancy_similarity(v))
    undecided = sim.needs_geometry(records, visual)
    flagged = sim.flag_false_positives(records, sim.min_geo_similarity(v.join(undecided, "group_id", "left_semi")), visual)
    return flagged.filter("is_false_positive and similarity_type = 'visual'").drop("type", "variant_count")


@query(
    "F6",
    "SELECT t AS threshold, (SELECT count(*) FROM box_score_fx WHERE max_score >= t) AS groups FROM (SELECT unnest([0.99::DOUBLE, 0.95, 0.9, 0.85, 0.8, 0.7, 0.5]) AS t)",
)
def score_distribution(spark, sf):
    return sim.score_distribution(sim.occupancy_similarity(boxes_by_label(spark, sf)))


# ---------------------------------------------------------------- decisions and allocation

part(
    "decision_fx",
    """SELECT rid, unmerge, form, group_no, group_type, list_pos, pos FROM (
  SELECT rid, rid % 14 = 0 AS unmerge, 'groups' AS form,
    (CASE WHEN rid % 5 = 1 AND pos > 0 THEN 1 + (pos + 1) % 2 ELSE 0 END)::INT AS group_no,
    CASE WHEN rid % 5 = 1 AND pos > 0 THEN 'pua' ELSE 'keep' END AS group_type,
    (CASE WHEN rid % 10 = 7 THEN variant_count - 1 - pos ELSE pos END)::INT AS list_pos, pos
  FROM variant_fx WHERE type <> 'glyph_duplicate' AND (rid % 5 IN (1, 2) OR (rid % 5 = 3 AND pos = 0))
  UNION ALL SELECT rid, rid % 14 = 0, 'variants', NULL, CASE pos WHEN 0 THEN 'keep' ELSE 'pua' END,
    (CASE WHEN rid % 10 = 7 THEN variant_count - 1 - pos ELSE pos END)::INT, pos
  FROM variant_fx WHERE type <> 'glyph_duplicate' AND rid % 5 = 4 AND pos < 2
  UNION ALL SELECT rid, true, 'variants', NULL, NULL, 0, NULL FROM record_fx WHERE type <> 'glyph_duplicate' AND rid % 70 = 0)""",
)


@query("N1", "SELECT * FROM decision_fx")
def decision_rows(spark, sf):
    return world(spark, sf).decisions


@query(
    "N2",
    f"""WITH free AS (SELECT c, row_number() OVER (ORDER BY c) AS k FROM range({LO}, {HI}+1) t(c) WHERE c NOT IN (SELECT code FROM entry_fx WHERE code IS NOT NULL)),
ask AS (SELECT glyph_hash, row_number() OVER (ORDER BY ord_major, glyph_hash) AS k FROM entry_fx WHERE source_count > 1)
SELECT glyph_hash, 'U+' || printf('%04X', c) AS pua, 'several sources' AS reason FROM ask JOIN free USING (k)""",
)
def code_allocation(spark, sf):
    entries = world(spark, sf).reg.entries
    ask = entries.filter(F.col("source_count") > 1).select(
        "glyph_hash", "ord_major", F.lit("several sources").alias("reason")
    )
    given = al.allocate(ask, ["ord_major", "glyph_hash"], entries.select("code"), LO, HI)
    return al.allocation_log(given)


# ---------------------------------------------------------------- resolution

part(
    "branch_fx",
    """SELECT *, CASE WHEN rid % 7 = 0 AND rid % 14 <> 0 THEN 'fp' WHEN rid % 5 IN (1, 2, 3) THEN 'groups' ELSE 'single' END AS branch
FROM variant_fx WHERE type <> 'glyph_duplicate'""",
)
part(
    "member_fx",
    """SELECT CASE type WHEN 'unicode_conflict' THEN 0 ELSE 1 END AS phase, rid AS k1, k2, lp, pos, type, key, glyph_hash, code, code_hex, name, advance_width, resolution, auto FROM (
  SELECT *, 0::BIGINT AS k2, pos AS lp, 'false_positive_merged' AS resolution, false AS auto FROM branch_fx WHERE branch = 'fp'
  UNION ALL SELECT b.*, d.group_no::BIGINT, d.list_pos::BIGINT, CASE d.group_type WHEN 'keep' THEN 'group_kept' ELSE 'group_pua' END, false
    FROM branch_fx b JOIN decision_fx d ON d.rid = b.rid AND d.pos = b.pos WHERE branch = 'groups' AND form = 'groups'
  UNION ALL SELECT b.*, b.pos, 0::BIGINT, CASE d.group_type WHEN 'keep' THEN 'kept_original' ELSE 'pua_assigned' END, d.group_type IS NULL
    FROM branch_fx b LEFT JOIN (SELECT * FROM decision_fx WHERE form = 'variants') d ON d.rid = b.rid AND d.pos = b.pos WHERE branch = 'single')""",
)
part(
    "item_fx",
    """SELECT phase, k1, k2, type, key, resolution, auto, merged_variant_count, glyph_hash, name, code_hex, advance_width, pos FROM (
  SELECT *, count(*) OVER (PARTITION BY phase, k1, k2) AS merged_variant_count, row_number() OVER (PARTITION BY phase, k1, k2 ORDER BY lp, pos) AS x FROM member_fx) WHERE x = 1""",
)
part(
    "item_source_fx",
    """SELECT phase, k1, k2, asset_id, original_code, lp, pos, src_rn FROM (
  SELECT m.phase, m.k1, m.k2, s.asset_id, s.original_code, m.lp, m.pos, s.src_rn, row_number() OVER (PARTITION BY m.phase, m.k1, m.k2, s.asset_id ORDER BY m.lp, m.pos, s.src_rn) AS x
  FROM member_fx m JOIN source_fx s ON s.glyph_hash = m.glyph_hash) WHERE x = 1""",
)
part("first_code_fx", "SELECT glyph_hash, arg_min(original_code, src_rn) AS first_code FROM source_fx GROUP BY 1")
part(
    "resolved_item_fx",
    f"""SELECT i.phase, i.k1, i.k2, i.glyph_hash,
  (CASE WHEN n.code IS NOT NULL THEN n.code WHEN i.phase = 0 THEN ('0x' || substr(i.key, 3))::BIGINT ELSE f.first_code END)::INT AS final_code,
  CASE WHEN n.code IS NOT NULL THEN printf('%04X', n.code) WHEN i.phase = 0 THEN substr(i.key, 3) ELSE printf('%04X', f.first_code) END AS final_hex,
  CASE i.phase WHEN 0 THEN coalesce(i.name, '') ELSE i.key END ||
    CASE i.resolution WHEN 'group_pua' THEN '_g' || (i.k2 + 1) WHEN 'pua_assigned' THEN '_v' || (i.pos + 1) ELSE '' END AS final_name,
  i.resolution, i.merged_variant_count, i.key AS conflict_key, i.type AS conflict_type, i.advance_width, 'simple' AS glyph_type, i.auto
FROM item_fx i JOIN first_code_fx f ON f.glyph_hash = i.glyph_hash LEFT JOIN (
  SELECT phase, k1, k2, {LO} - 1 + row_number() OVER (ORDER BY phase, k1, k2) AS code FROM item_fx WHERE resolution IN ('group_pua', 'pua_assigned')) n
  ON n.phase = i.phase AND n.k1 = i.k1 AND n.k2 = i.k2""",
)
part(
    "rest_fx",
    """SELECT 2 AS phase, ord_major AS k1, 0::BIGINT AS k2, glyph_hash, code AS final_code, coalesce(code_hex, '') AS final_hex, coalesce(name, '') AS final_name,
  CASE WHEN source_count > 1 THEN 'alias_merged' ELSE 'single_source' END AS resolution, advance_width, glyph_type,
  CASE WHEN source_count > 1 THEN source_count END AS merged_source_count FROM entry_fx""",
)
part(
    "final_fx",
    """SELECT * EXCLUDE (x) FROM (SELECT *, row_number() OVER (PARTITION BY glyph_hash ORDER BY phase, k1, k2) AS x FROM (
  SELECT phase, k1, k2, glyph_hash, final_code, final_hex, final_name, resolution, merged_variant_count, conflict_key, conflict_type, advance_width, glyph_type, NULL::BIGINT AS merged_source_count FROM resolved_item_fx
  UNION ALL SELECT phase, k1, k2, glyph_hash, final_code, final_hex, final_name, resolution, NULL, NULL, NULL, advance_width, glyph_type, merged_source_count FROM rest_fx)) WHERE x = 1""",
)
part(
    "item_alias_fx",
    """SELECT DISTINCT phase, k1, k2, alias FROM (SELECT phase, k1, k2, CASE
    WHEN phase = 1 AND resolution IN ('group_pua', 'pua_assigned') THEN key
    WHEN resolution IN ('false_positive_merged', 'group_kept', 'group_pua') THEN nullif(name, '')
    WHEN resolution = 'pua_assigned' THEN coalesce(name, '') END AS alias FROM member_fx) WHERE alias IS NOT NULL""",
)
part(
    "final_alias_fx",
    """SELECT f.glyph_hash, a.alias FROM final_fx f JOIN item_alias_fx a ON a.phase = f.phase AND a.k1 = f.k1 AND a.k2 = f.k2
UNION ALL SELECT f.glyph_hash, a.alias FROM final_fx f JOIN alias_fx a ON a.glyph_hash = f.glyph_hash WHERE f.phase = 2""",
)
part(
    "final_source_fx",
    """SELECT glyph_hash, asset_id, original_code, row_number() OVER (PARTITION BY glyph_hash ORDER BY phase, k1, k2, lp, pos, src_rn) AS at FROM (
  SELECT *, row_number() OVER (PARTITION BY glyph_hash, asset_id ORDER BY phase, k1, k2, lp, pos, src_rn) AS x FROM (
    SELECT i.glyph_hash, s.* FROM item_source_fx s JOIN item_fx i ON i.phase = s.phase AND i.k1 = s.k1 AND i.k2 = s.k2
    UNION ALL SELECT glyph_hash, 2, 0, 0, asset_id, original_code, 0, 0, src_rn FROM source_fx)) WHERE x = 1""",
)


def _fresh_members(w):
    return rs.item_members(
        w.records.filter(F.col("type") != cf.DUPLICATE), w.variants, w.decisions
    )


def shared_members(w):
    if not hasattr(w, "_members"):
        w._members = materialize(_fresh_members(w))
    return w._members


def shared_resolution(w):
    if not hasattr(w, "_resolution"):
        res = rs.resolve(w.reg, w.records, w.variants, w.decisions, LO, HI)
        w._resolution = rs.Resolution(
            materialize(res.glyphs), materialize(res.aliases), materialize(res.sources)
        )
    return w._resolution


@query(
    "N3",
    "SELECT phase, k1, k2, type, key, resolution, merged_variant_count, auto, glyph_hash, name, code_hex, advance_width, pos FROM item_fx",
)
def merged_items(spark, sf):
    return rs.merge_variants(_fresh_members(world(spark, sf)))


@query(
    "N3",
    "SELECT phase, k1, k2, asset_id, original_code, lp::BIGINT AS list_pos, pos::BIGINT AS pos, src_rn - 1 AS src_ord FROM item_source_fx",
)
def merged_item_sources(spark, sf):
    w = world(spark, sf)
    rows = rs.item_sources(shared_members(w), w.reg.sources)
    return rows.withColumns({c: F.col(f"src_at.{c}").cast("long") for c in ("list_pos", "pos", "src_ord")}).drop("src_at")


@query("N3", "SELECT phase, k1, k2, alias FROM item_alias_fx")
def merged_item_aliases(spark, sf):
    return rs.item_aliases(shared_members(world(spark, sf)))


@query(
    "N3",
    """SELECT DISTINCT s.phase, s.k1, s.k2, p.project FROM item_source_fx s JOIN asset_project_fx p ON p.asset_id = s.asset_id""",
)
def merged_item_projects(spark, sf):
    w = world(spark, sf)
    mine = rs.item_sources(_fresh_members(w), w.reg.sources).join(w.asset_projects, "asset_id")
    return mine.select("phase", "k1", "k2", "project").distinct()


def _resolved(spark, sf, kind):
    w = world(spark, sf)
    items = rs.resolve_items(shared_members(w), w.reg.sources, LO, HI)
    return items.filter(F.col("conflict_type") == kind)


@query("N4", "SELECT * FROM resolved_item_fx WHERE conflict_type = 'unicode_conflict'")
def resolved_code_conflicts(spark, sf):
    return _resolved(spark, sf, cf.CODE_CONFLICT)


@query("N5", "SELECT * FROM resolved_item_fx WHERE conflict_type = 'name_conflict'")
def resolved_name_conflicts(spark, sf):
    return _resolved(spark, sf, cf.NAME_CONFLICT)


@query("N6", "SELECT glyph_hash, final_code, final_hex, final_name, resolution, merged_source_count FROM rest_fx")
def resolved_rest(spark, sf):
    return rs.resolve_rest(world(spark, sf).reg.entries).select(
        "glyph_hash", "final_code", "final_hex", "final_name", "resolution", "merged_source_count"
    )


@query(
    "N7",
    """SELECT glyph_hash, phase, k1, k2, final_code, final_hex, final_name, resolution, merged_variant_count, conflict_key, conflict_type, merged_source_count FROM final_fx""",
)
def combined_resolution(spark, sf):
    return shared_resolution(world(spark, sf)).glyphs.drop("advance_width", "glyph_type", "auto")


@query("N7", "SELECT glyph_hash, asset_id, original_code FROM final_source_fx")
def combined_sources(spark, sf):
    return shared_resolution(world(spark, sf)).sources.drop("src_ord")


@query("N7", "SELECT glyph_hash, alias FROM final_alias_fx")
def combined_aliases(spark, sf):
    return shared_resolution(world(spark, sf)).aliases


@query(
    "N8",
    """SELECT name, glyph_hash FROM (SELECT c.name, c.glyph_hash, row_number() OVER (PARTITION BY c.name ORDER BY f.phase DESC, f.k1 DESC, f.k2 DESC, f.glyph_hash DESC) AS x FROM (
  SELECT glyph_hash, final_name AS name FROM final_fx WHERE final_name <> '' UNION ALL SELECT glyph_hash, alias FROM final_alias_fx) c JOIN final_fx f ON f.glyph_hash = c.glyph_hash) WHERE x = 1""",
)
def alias_map(spark, sf):
    return rs.alias_map(shared_resolution(world(spark, sf)))


@query(
    "N9",
    """SELECT type, kept, assigned, auto_resolved, merged_whole, group_merged, kept + assigned + auto_resolved + merged_whole + group_merged AS settled FROM (
 SELECT type, count(*) FILTER (resolution IN ('kept_original', 'group_kept')) AS kept, count(*) FILTER (resolution IN ('group_pua', 'pua_assigned')) AS assigned,
  count(*) FILTER (auto) AS auto_resolved, count(*) FILTER (resolution = 'false_positive_merged') AS merged_whole,
  count(*) FILTER (resolution LIKE 'group%') AS group_merged FROM item_fx GROUP BY 1)""",
)
def resolution_statistics(spark, sf):
    w = world(spark, sf)
    items = rs.resolve_items(shared_members(w), w.reg.sources, LO, HI)
    return rs.resolution_stats(items, w.records.filter(F.col("type") != cf.DUPLICATE), w.decisions)


@query(
    "N9",
    """SELECT count(*) AS codes_assigned, 'U+' || printf('%04X', min(final_code)) || '-U+' || printf('%04X', max(final_code)) AS range_used
FROM resolved_item_fx WHERE resolution IN ('group_pua', 'pua_assigned')""",
)
def assigned_code_range(spark, sf):
    w = world(spark, sf)
    return rs.code_range_used(rs.resolve_items(shared_members(w), w.reg.sources, LO, HI))


@query("N9", "SELECT resolution, count(*) AS glyphs FROM final_fx GROUP BY 1")
def resolution_histogram(spark, sf):
    return rs.resolution_histogram(shared_resolution(world(spark, sf)).glyphs)


# ---------------------------------------------------------------- registry rewrites

part(
    "name_item_fx",
    """SELECT i.*, CASE WHEN resolution = 'group_pua' THEN row_number() OVER (PARTITION BY k1, resolution ORDER BY k2) END AS nth,
  CASE WHEN resolution = 'group_pua' THEN row_number() OVER (PARTITION BY resolution ORDER BY k1, k2) END AS ask
FROM item_fx i WHERE type = 'name_conflict' AND resolution IN ('false_positive_merged', 'group_kept', 'group_pua')""",
)
part(
    "consumed_fx",
    "SELECT DISTINCT glyph_hash FROM member_fx WHERE type = 'name_conflict' AND resolution IN ('false_positive_merged', 'group_kept', 'group_pua')",
)
part(
    "renamed_entry_fx",
    f"""SELECT glyph_hash, code, code_hex, name, source_count, alias_count FROM entry_fx WHERE glyph_hash NOT IN (SELECT glyph_hash FROM consumed_fx)
UNION ALL SELECT i.glyph_hash, (CASE WHEN ask IS NULL THEN first_code ELSE {LO} - 1 + ask END)::INT, CASE WHEN ask IS NULL THEN i.code_hex ELSE printf('%04X', {LO} - 1 + ask) END,
  i.key || CASE WHEN ask IS NULL THEN '' ELSE '_v' || (nth + 1) END,
  (SELECT count(*) FROM item_source_fx s WHERE s.phase = 1 AND s.k1 = i.k1 AND s.k2 = i.k2),
  (SELECT count(DISTINCT coalesce(m.name, '')) FROM member_fx m WHERE m.phase = 1 AND m.k1 = i.k1 AND m.k2 = i.k2)
FROM name_item_fx i JOIN first_code_fx f ON f.glyph_hash = i.glyph_hash""",
)


def _renamed(w):
    return rw.apply_name_resolution(w.reg, w.records, w.variants, w.decisions, LO, HI)


@query("N10", "SELECT * FROM renamed_entry_fx")
def registry_after_names(spark, sf):
    return _renamed(world(spark, sf)).entries.select(
        "glyph_hash", "code", "code_hex", "name", "source_count", "alias_count"
    )


@query(
    "N10",
    """SELECT glyph_hash, asset_id, original_code FROM source_fx WHERE glyph_hash NOT IN (SELECT glyph_hash FROM consumed_fx)
UNION ALL SELECT i.glyph_hash, s.asset_id, s.original_code FROM name_item_fx i JOIN item_source_fx s ON s.phase = i.phase AND s.k1 = i.k1 AND s.k2 = i.k2""",
)
def sources_after_names(spark, sf):
    return _renamed(world(spark, sf)).sources.drop("src_ord")


@query(
    "N10",
    """SELECT count(*) FILTER (b = 'fp') AS fp_merged, count(*) FILTER (b = 'groups') AS decision_merged,
  (SELECT count(*) FROM name_item_fx WHERE resolution = 'group_pua') AS codes_given, count(*) FILTER (b = 'single') AS skipped
FROM (SELECT rid, min(branch) AS b FROM branch_fx WHERE type = 'name_conflict' GROUP BY 1)""",
)
def name_resolution_statistics(spark, sf):
    w = world(spark, sf)
    return rw.name_resolution_stats(w.records, w.variants, w.decisions)


@query("S4", "SELECT glyph_hash, code, name FROM renamed_entry_fx")
def current_registry(spark, sf):
    w = world(spark, sf)
    return registry_current(w.reg.entries, _renamed(w).entries).select("glyph_hash", "code", "name")


part(
    "user_fx",
    f"""SELECT glyph_hash, old_code, old_hex, c::INT AS new_code, printf('%04X', c) AS new_hex, 'Type A conflict resolution for ' || key AS reason FROM (
  SELECT v.glyph_hash, v.code AS old_code, v.code_hex AS old_hex, v.key, row_number() OVER (ORDER BY d.rid, d.group_no, d.list_pos, d.pos) AS k
  FROM decision_fx d JOIN variant_fx v ON v.rid = d.rid AND v.pos = d.pos WHERE v.type = 'unicode_conflict' AND form = 'groups' AND group_type = 'pua')
JOIN (SELECT c, row_number() OVER (ORDER BY c) AS k FROM range({LO}, {HI}+1) t(c) WHERE c NOT IN (SELECT code FROM entry_fx WHERE code IS NOT NULL)) USING (k)""",
)
part(
    "entry1_fx",
    "SELECT e.* REPLACE (coalesce(u.new_code, e.code) AS code, coalesce(u.new_hex, e.code_hex) AS code_hex) FROM entry_fx e LEFT JOIN user_fx u ON u.glyph_hash = e.glyph_hash",
)
part(
    "taken_fx",
    "SELECT code FROM entry_fx WHERE code IS NOT NULL UNION SELECT new_code FROM user_fx",
)
part(
    "keeper_fx",
    """SELECT rid, coalesce(min(CASE WHEN best = 1 THEN pos END) FILTER (rid % 5 = 0 AND rid % 14 <> 0), min(CASE WHEN listed = 1 THEN pos END) FILTER (rid % 5 = 2), 0) AS keep_pos FROM (
  SELECT rid, pos, row_number() OVER (PARTITION BY rid ORDER BY source_count DESC, pos) AS best,
    row_number() OVER (PARTITION BY rid ORDER BY source_count DESC, CASE WHEN rid % 10 = 7 THEN -pos ELSE pos END) AS listed
  FROM variant_fx WHERE type = 'unicode_conflict') GROUP BY rid""",
)
part(
    "auto_fx",
    f"""SELECT glyph_hash, old_code, old_hex, c::INT AS new_code, printf('%04X', c) AS new_hex, 'Type A auto resolution for ' || key AS reason FROM (
  SELECT v.glyph_hash, e.code AS old_code, e.code_hex AS old_hex, v.key, row_number() OVER (ORDER BY v.rid, v.pos) AS k
  FROM variant_fx v JOIN keeper_fx p ON p.rid = v.rid JOIN variant_fx kv ON kv.rid = p.rid AND kv.pos = p.keep_pos
  JOIN entry1_fx ke ON ke.glyph_hash = kv.glyph_hash JOIN entry1_fx e ON e.glyph_hash = v.glyph_hash
  WHERE v.type = 'unicode_conflict' AND v.pos <> p.keep_pos AND e.code = ke.code)
JOIN (SELECT c, row_number() OVER (ORDER BY c) AS k FROM range({LO}, {HI}+1) t(c) WHERE c NOT IN (SELECT code FROM taken_fx)) USING (k)""",
)
part(
    "fresh_fx",
    """SELECT code, min(code_hex) AS hex, count(*) AS n FROM entry1_fx WHERE code IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
)
part(
    "fallback_fx",
    f"""SELECT glyph_hash, old_code, old_hex, c::INT AS new_code, printf('%04X', c) AS new_hex, 'Type A fallback resolution for U+' || old_hex AS reason FROM (
  SELECT glyph_hash, code AS old_code, hex AS old_hex, row_number() OVER (ORDER BY CASE WHEN n >= 5 THEN 0 WHEN n >= 3 THEN 1 ELSE 2 END, hex, pos) AS k FROM (
    SELECT e.glyph_hash, e.code, f.hex, f.n, row_number() OVER (PARTITION BY e.code ORDER BY ord_major, e.glyph_hash) AS pos FROM entry1_fx e JOIN fresh_fx f ON f.code = e.code)
  WHERE pos > 1 AND glyph_hash NOT IN (SELECT glyph_hash FROM user_fx))
JOIN (SELECT c, row_number() OVER (ORDER BY c) AS k FROM range({LO}, {HI}+1) t(c) WHERE c NOT IN (SELECT code FROM taken_fx)) USING (k)""",
)


def _user(w):
    if not hasattr(w, "_user"):
        w._user = materialize(
            rw.apply_code_user(w.reg.entries, w.records, w.variants, w.decisions, LO, HI)
        )
    return w._user


def _taken(w):
    return w.reg.entries.select("code").union(_user(w).select("new_code"))


def _auto(w):
    entries = rw.with_changes(w.reg.entries, _user(w))
    return rw.apply_code_auto(entries, w.records, w.variants, w.decisions, _taken(w), LO, HI)


@query("N11", "SELECT * FROM user_fx")
def codes_moved_by_reviewers(spark, sf):
    w = world(spark, sf)
    return rw.apply_code_user(w.reg.entries, w.records, w.variants, w.decisions, LO, HI)


@query("N11", "SELECT DISTINCT rid FROM decision_fx WHERE rid NOT IN (SELECT rid FROM record_fx WHERE type = 'unicode_conflict')")
def skipped_decisions(spark, sf):
    w = world(spark, sf)
    return rw.skipped_decisions(w.records, w.decisions)


@query("N12", "SELECT rid, keep_pos FROM keeper_fx")
def code_keepers(spark, sf):
    w = world(spark, sf)
    return rw.code_keepers(w.reg.entries, w.records, w.variants, w.decisions)


@query("N12", "SELECT * FROM auto_fx")
def codes_moved_automatically(spark, sf):
    return _auto(world(spark, sf))


@query("N13", "SELECT * FROM fallback_fx")
def codes_moved_as_fallback(spark, sf):
    w = world(spark, sf)
    entries = rw.with_changes(w.reg.entries, _user(w))
    fresh = cf.number_records(cf.all_conflicts(entries))
    variants = cf.conflict_variants(entries, fresh.filter(F.col("type") == cf.CODE_CONFLICT))
    return rw.apply_code_fallback(entries, fresh, variants, _user(w), _taken(w), LO, HI)


@query(
    "N14",
    """SELECT glyph_hash, 'assign_pua' AS action, old_code, old_hex, new_code, new_hex, reason FROM user_fx
UNION ALL SELECT glyph_hash, 'assign_pua', old_code, old_hex, new_code, new_hex, reason FROM auto_fx""",
)
def code_change_log(spark, sf):
    w = world(spark, sf)
    return rw.lineage_log(_user(w)).unionByName(rw.lineage_log(_auto(w)))


@query(
    "N14",
    """SELECT glyph_hash, 'assign_pua' AS action, old_code, old_hex, new_code, new_hex, reason, TIMESTAMP '2024-01-02 03:04:05' AS run_at FROM user_fx
UNION ALL SELECT glyph_hash, 'assign_pua', old_code, old_hex, new_code, new_hex, reason, TIMESTAMP '2024-01-03 03:04:05' FROM auto_fx""",
)
def appended_change_log(spark, sf):
    w, path = world(spark, sf), scratch_path(spark, "lineage")
    # The first run is repeated, as after a failure: its rows stand once.
    for _ in range(2):
        rw.append_lineage(_user(w), path, "2024-01-02 03:04:05")
    return rw.append_lineage(_auto(w), path, "2024-01-03 03:04:05")


part(
    "effect_fx",
    """SELECT group_id, key, count(DISTINCT now) AS hashes_left, CASE WHEN count(DISTINCT now) <= 1 THEN 'eliminated' WHEN bool_or(now <> glyph_hash) THEN 'modified' ELSE 'remaining' END AS outcome FROM (
  SELECT v.group_id, v.key, v.glyph_hash, coalesce(f.canonical, v.glyph_hash) AS now FROM variant_fx v
  LEFT JOIN (SELECT key AS name, glyph_hash AS canonical FROM variant_fx WHERE type = 'name_conflict' AND pos = 0 AND rid % 7 = 0) f ON f.name = v.name
  WHERE v.type = 'unicode_conflict') GROUP BY 1, 2""",
)


def _effect(w):
    return rw.name_first_effect(w.records, w.variants)


@query("N15", "SELECT * FROM effect_fx")
def name_first_outcomes(spark, sf):
    return _effect(world(spark, sf))


@query(
    "N15",
    """SELECT count(*) AS type_a_total, count(*) FILTER (outcome = 'eliminated') AS eliminated, count(*) FILTER (outcome <> 'eliminated') AS remaining,
  count(*) FILTER (outcome = 'modified') AS modified, round(count(*) FILTER (outcome = 'eliminated') * 100.0::DOUBLE / count(*), 1) AS eliminated_pct,
  round(count(*) FILTER (outcome <> 'eliminated') * 100.0::DOUBLE / count(*), 1) AS remaining_pct FROM effect_fx""",
)
def name_first_summary(spark, sf):
    return rw.name_first_summary(_effect(world(spark, sf)))


part(
    "queue_fx",
    """SELECT type, severity, key, variant_count, rid FROM record_fx WHERE NOT (type = 'name_conflict' AND rid % 7 = 0)
AND group_id NOT IN (SELECT group_id FROM effect_fx WHERE outcome = 'eliminated')""",
)


@query("N16", "SELECT type, severity, key, variant_count, rid FROM queue_fx")
def review_queue(spark, sf):
    w = world(spark, sf)
    return rw.review_queue(w.records, _effect(w)).select("type", "severity", "key", "variant_count", "rid")


@query("N16", "SELECT type, count(*) AS records FROM queue_fx GROUP BY 1")
def review_queue_counts(spark, sf):
    w = world(spark, sf)
    return rw.review_queue_counts(rw.review_queue(w.records, _effect(w)))


@query(
    "N17",
    """WITH five AS (SELECT glyph_hash, string_agg(project, ', ' ORDER BY k) AS projects FROM (
  SELECT s.glyph_hash, p.project, row_number() OVER (PARTITION BY s.glyph_hash ORDER BY src_rn, p.project) AS k FROM source_fx s JOIN asset_project_fx p ON p.asset_id = s.asset_id) WHERE k <= 5 GROUP BY 1)
SELECT rid AS id, type, severity, key, variant_count, pos, v.glyph_hash, coalesce(nullif(name, ''), '(none)') AS name, source_count, coalesce(projects, '') AS projects
FROM variant_fx v LEFT JOIN five f ON f.glyph_hash = v.glyph_hash WHERE type = 'name_conflict' AND rid % 7 <> 0""",
)
def name_review_table(spark, sf):
    w = world(spark, sf)
    return rw.review_table(w.records, w.variants, w.reg.sources, w.asset_projects, cf.NAME_CONFLICT)
