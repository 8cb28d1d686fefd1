"""Registry and conflicts: queries and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import part, query
from catalog.fixtures import glyphs, view, world
from glyphledger.operators import conflicts as cf
from glyphledger.operators import registry as rg
from glyphledger.session import scratch_path
from glyphledger.sources.records import write_records

part(
    "fine_fx",
    "SELECT glyph_hash, code, coalesce(icon_name, '') AS name, asset_id, count(*) AS n, min(rn) AS o FROM glyph_fx WHERE glyph_hash <> 'empty' GROUP BY ALL",
)
part(
    "canon_fx",
    """SELECT c.glyph_hash, c.code, m.name, a.asset_id FROM
 (SELECT * FROM (SELECT glyph_hash, code, row_number() OVER (PARTITION BY glyph_hash ORDER BY sum(n) DESC, min(o)) AS k FROM fine_fx GROUP BY 1, 2) WHERE k = 1) c
 JOIN (SELECT * FROM (SELECT glyph_hash, code, name, row_number() OVER (PARTITION BY glyph_hash, code ORDER BY sum(n) DESC, min(o)) AS k FROM fine_fx GROUP BY 1, 2, 3) WHERE k = 1) m USING (glyph_hash, code)
 JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY glyph_hash, code, name ORDER BY n DESC, o) AS k FROM fine_fx) WHERE k = 1) a USING (glyph_hash, code, name)""",
)
part("alias_fx", "SELECT DISTINCT glyph_hash, icon_name AS alias FROM glyph_fx WHERE glyph_hash <> 'empty' AND icon_name <> ''")
part("source_fx", "SELECT glyph_hash, asset_id, arg_min(code, rn) AS original_code, min(rn) AS src_rn FROM glyph_fx GROUP BY 1, 2")
part(
    "entry_fx",
    """SELECT s.glyph_hash, c.code, printf('%04X', c.code) AS code_hex, c.name, c.asset_id,
  CASE WHEN s.glyph_hash = 'empty' THEN 'empty' ELSE f.glyph_type END AS glyph_type,
  CASE WHEN s.glyph_hash = 'empty' THEN 0 ELSE f.num_contours END AS num_contours, f.advance_width,
  coalesce(a.n, 0) AS alias_count, s.n AS source_count, coalesce(c.code, 0)::BIGINT AS ord_major
FROM (SELECT glyph_hash, count(*) AS n FROM source_fx GROUP BY 1) s
LEFT JOIN canon_fx c ON c.glyph_hash = s.glyph_hash
LEFT JOIN (SELECT glyph_hash, count(*) AS n FROM alias_fx GROUP BY 1) a ON a.glyph_hash = s.glyph_hash
LEFT JOIN (SELECT glyph_hash, arg_min(advance_width, rn) AS advance_width, arg_min(glyph_type, rn) AS glyph_type, arg_min(num_contours, rn) AS num_contours
  FROM glyph_fx WHERE glyph_hash <> 'empty' GROUP BY 1) f ON f.glyph_hash = s.glyph_hash""",
)


@query("R1", "SELECT glyph_hash, count(*) AS rows, count(DISTINCT asset_id) AS assets FROM glyph_fx GROUP BY 1")
def fingerprint_groups(spark, sf):
    return rg.by_hash(glyphs(spark, sf))


@query("R2", "SELECT glyph_hash, code, name, asset_id FROM canon_fx")
def canonical_pick(spark, sf):
    return rg.select_canonical(glyphs(spark, sf))


@query("R3", "SELECT glyph_hash, alias FROM alias_fx")
def alias_sets(spark, sf):
    return rg.aliases(glyphs(spark, sf))


@query(
    "R3",
    """SELECT glyph_hash, rn - 1 AS ord, asset_id, icon_name, code, printf('%04X', code) AS code_hex FROM glyph_fx
WHERE glyph_hash <> 'empty' AND icon_name <> ''""",
)
def alias_detail_rows(spark, sf):
    return rg.alias_details(glyphs(spark, sf))


@query(
    "R4",
    "SELECT glyph_hash, asset_id, original_code, css_url, src_rn - 1 AS src_ord FROM source_fx LEFT JOIN (SELECT asset_id, css_url FROM asset_fx) USING (asset_id)",
)
def source_rows(spark, sf):
    return rg.source_details(rg.sources(glyphs(spark, sf)), view(spark, sf, "asset_fx"))


@query("R4", "SELECT glyph_hash, asset_id, project FROM source_fx JOIN asset_project_fx USING (asset_id)")
def source_project_rows(spark, sf):
    return rg.source_projects(rg.sources(glyphs(spark, sf)), view(spark, sf, "asset_project_fx"))


@query("R5", "SELECT * FROM entry_fx")
def registry_entries(spark, sf):
    return rg.build_registry(glyphs(spark, sf)).entries


@query(
    "R5",
    "SELECT glyph_hash, arg_min(has_outline, rn) AS has_outline FROM glyph_fx WHERE glyph_hash <> 'empty' GROUP BY 1",
)
def registry_outlines(spark, sf):
    first = rg.outlines(
        glyphs(spark, sf).withColumn("contours", F.coalesce("contours", F.array().cast("array<array<struct<x:double,y:double,on_curve:boolean>>>")))
    )
    return first.select("glyph_hash", (F.size("contours") > 0).alias("has_outline"))


@query("R6", "SELECT glyph_hash, code FROM entry_fx WHERE code IS NOT NULL")
def code_map(spark, sf):
    return rg.unicode_map(world(spark, sf).reg.entries)


@query("R7", "SELECT glyph_hash, code, code_hex, name, asset_id, alias_count, source_count, glyph_type FROM entry_fx")
def slim_index(spark, sf):
    return rg.hash_index(world(spark, sf).reg.entries)


@query(
    "R8",
    """SELECT e.glyph_hash, e.code, e.code_hex, e.name, e.asset_id AS canonical_asset_id, s.asset_id, s.original_code
FROM entry_fx e JOIN source_fx s ON s.glyph_hash = e.glyph_hash""",
)
def lineage_rows(spark, sf):
    return rg.lineage(world(spark, sf).reg)


@query(
    "R9",
    """SELECT count(*) AS total_entries, count(*) FILTER (glyph_type = 'simple') AS simple, count(*) FILTER (glyph_type = 'empty') AS empty,
  count(*) FILTER (source_count > 1) AS multi_source_entries, max(source_count) AS max_sources_per_entry, sum(alias_count)::BIGINT AS total_aliases,
  count(*) - count(*) FILTER (source_count > 1) AS single_source, count(*) FILTER (source_count BETWEEN 2 AND 5) AS two_to_five,
  count(*) FILTER (source_count BETWEEN 6 AND 10) AS six_to_ten, count(*) FILTER (source_count > 10) AS eleven_plus FROM entry_fx""",
)
def registry_summary(spark, sf):
    return rg.registry_summary(world(spark, sf).reg.entries)


@query(
    "R10",
    """SELECT glyph_hash, coalesce(nullif(name, ''), '(empty)') AS name, source_count, alias_count FROM entry_fx
ORDER BY source_count DESC, ord_major, glyph_hash LIMIT 10""",
)
def most_shared_entries(spark, sf):
    return rg.top_duplicates(world(spark, sf).reg.entries)


@query(
    "R10",
    """SELECT glyph_hash, coalesce(nullif(name, ''), '(empty)') AS name, alias_count,
  coalesce((SELECT string_agg(alias, ', ' ORDER BY alias) FROM (SELECT alias FROM alias_fx a WHERE a.glyph_hash = e.glyph_hash ORDER BY alias LIMIT 5)), '')
  || CASE WHEN alias_count > 5 THEN ' ... (+' || (alias_count - 5) || ')' ELSE '' END AS preview
FROM (SELECT * FROM entry_fx ORDER BY alias_count DESC, ord_major, glyph_hash LIMIT 10) e""",
)
def most_aliased_entries(spark, sf):
    return rg.top_aliases(world(spark, sf).reg)


@query(
    "R11",
    """SELECT glyph_hash, name, coalesce(code_hex, '') AS code_hex, source_count FROM entry_fx
ORDER BY coalesce(code_hex, '') = '', coalesce(code_hex, ''), ord_major, glyph_hash LIMIT 100""",
)
def name_listing(spark, sf):
    return rg.name_listing(world(spark, sf).reg.entries)


@query(
    "R11",
    "SELECT count(*) AS entries, count(*) FILTER (code_hex LIKE 'E%' AND length(code_hex) = 4) AS private_codes FROM entry_fx",
)
def private_codes(spark, sf):
    return rg.private_code_count(world(spark, sf).reg.entries)


# ---------------------------------------------------------------- conflicts


def _sev(n: str) -> str:
    return f"CASE WHEN {n} >= 5 THEN 'critical' WHEN {n} >= 3 THEN 'warning' ELSE 'info' END"


part(
    "code_conflict_fx",
    f"""SELECT 'unicode_conflict' AS type, {_sev('count(*)')} AS severity, 'U+' || min(code_hex) AS key, count(*) AS variant_count,
  'assign_pua' AS resolution_hint, 'c' || code AS group_id FROM entry_fx WHERE code IS NOT NULL GROUP BY code HAVING count(DISTINCT glyph_hash) > 1""",
)
part(
    "name_conflict_fx",
    f"""SELECT 'name_conflict' AS type, {_sev('count(*)')} AS severity, name AS key, count(*) AS variant_count,
  'rename' AS resolution_hint, 'n' || name AS group_id FROM entry_fx WHERE name <> '' GROUP BY name HAVING count(DISTINCT glyph_hash) > 1""",
)
part(
    "duplicate_fx",
    f"""SELECT 'glyph_duplicate' AS type, {_sev('source_count')} AS severity, glyph_hash AS key, 1::BIGINT AS variant_count,
  'merge_alias' AS resolution_hint, 'h' || glyph_hash AS group_id FROM entry_fx WHERE source_count > 1""",
)
part(
    "record_fx",
    """SELECT *, (row_number() OVER (ORDER BY sr, key, tr, group_id) - 1)::BIGINT AS rid FROM (
  SELECT *, CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END AS sr,
    CASE type WHEN 'unicode_conflict' THEN 1 WHEN 'name_conflict' THEN 2 ELSE 3 END AS tr
  FROM (SELECT * FROM code_conflict_fx UNION ALL SELECT * FROM name_conflict_fx UNION ALL SELECT * FROM duplicate_fx))""",
)
part(
    "variant_fx",
    """SELECT group_id, type, rid, key, severity, variant_count, (row_number() OVER (PARTITION BY group_id ORDER BY ord_major, glyph_hash) - 1)::BIGINT AS pos,
  glyph_hash, code, code_hex, name, source_count, advance_width
FROM (SELECT r.*, e.* EXCLUDE (asset_id) FROM record_fx r JOIN entry_fx e ON r.type = 'unicode_conflict' AND r.group_id = 'c' || e.code
 UNION ALL SELECT r.*, e.* EXCLUDE (asset_id) FROM record_fx r JOIN entry_fx e ON r.type = 'name_conflict' AND r.group_id = 'n' || e.name
 UNION ALL SELECT r.*, e.* EXCLUDE (asset_id) FROM record_fx r JOIN entry_fx e ON r.type = 'glyph_duplicate' AND r.group_id = 'h' || e.glyph_hash)""",
)

RECORD = "type, severity, key, variant_count, resolution_hint, group_id"


@query("C1", f"SELECT {RECORD} FROM code_conflict_fx")
def code_conflicts(spark, sf):
    return cf.code_conflicts(world(spark, sf).reg.entries)


@query("C2", f"SELECT {RECORD} FROM name_conflict_fx")
def name_conflicts(spark, sf):
    return cf.name_conflicts(world(spark, sf).reg.entries)


@query("C3 C4", f"SELECT {RECORD} FROM duplicate_fx")
def duplicate_records(spark, sf):
    return cf.duplicates(world(spark, sf).reg.entries)


@query("C6 N1", f"SELECT rid, {RECORD} FROM record_fx")
def conflict_records(spark, sf):
    entries = rg.build_registry(glyphs(spark, sf)).entries
    return cf.number_records(cf.all_conflicts(entries)).drop("severity_rank", "type_rank")


@query("C5", "SELECT group_id, type, pos, glyph_hash, code_hex, name, source_count, advance_width FROM variant_fx")
def conflict_variants(spark, sf):
    w = world(spark, sf)
    return cf.conflict_variants(w.reg.entries, w.records).select(
        "group_id", "type", "pos", "glyph_hash", "code_hex", "name", "source_count", "advance_width"
    )


@query(
    "C5",
    """SELECT DISTINCT group_id, 'asset' AS kind, s.asset_id AS member FROM variant_fx v JOIN source_fx s ON s.glyph_hash = v.glyph_hash
UNION ALL SELECT DISTINCT group_id, 'project', p.project FROM variant_fx v JOIN source_fx s ON s.glyph_hash = v.glyph_hash JOIN asset_project_fx p ON p.asset_id = s.asset_id""",
)
def affected_members(spark, sf):
    w = world(spark, sf)
    return cf.affected(w.variants, w.reg.sources, w.asset_projects)


@query(
    "C7",
    "SELECT coalesce(type, 'all') AS type, coalesce(severity, 'all') AS severity, count(*) AS records FROM record_fx GROUP BY CUBE (type, severity)",
)
def conflict_matrix(spark, sf):
    return cf.conflict_matrix(world(spark, sf).records)


@query(
    "S8 C7",
    """SELECT count(*) AS total_conflicts, count(*) FILTER (type = 'unicode_conflict') AS unicode_conflict, count(*) FILTER (type = 'name_conflict') AS name_conflict,
  count(*) FILTER (type = 'glyph_duplicate') AS glyph_duplicate, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning,
  count(*) FILTER (severity = 'info') AS info FROM record_fx""",
)
def conflict_run_totals(spark, sf):
    records = world(spark, sf).records
    path = scratch_path(spark, "conflicts") + ".parquet"
    write_records(records, path, cf.RECORD_ORDER, cf.conflict_totals(records))
    return spark.read.parquet(path.replace(".parquet", ".meta.parquet"))


@query("C8", "SELECT code_hex AS value, count(*) AS entries FROM entry_fx WHERE code_hex <> '' GROUP BY 1 HAVING count(*) > 1")
def code_collisions(spark, sf):
    return cf.entry_collisions(world(spark, sf).reg.entries, "code_hex")


@query("C8", "SELECT name AS value, count(*) AS entries FROM entry_fx WHERE name <> '' GROUP BY 1 HAVING count(*) > 1")
def name_collisions(spark, sf):
    return cf.entry_collisions(world(spark, sf).reg.entries, "name")


@query(
    "C9",
    """SELECT key, variant_count, coalesce(key IN (SELECT key FROM record_fx WHERE severity = 'critical'), false) AS in_review
FROM record_fx WHERE type = 'unicode_conflict'""",
)
def residual_conflicts(spark, sf):
    records = world(spark, sf).records
    return cf.residual(records, records.filter(F.col("severity") == "critical"))
