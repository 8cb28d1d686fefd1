"""Usage, lineage, publishing, rewrite plan and checks: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import part, query
from catalog.fixtures import view, world
from catalog.resolution_queries import shared_members, shared_resolution
from catalog.text_queries import ICON_ATTR, ICON_DYN, ICON_TOK, LINK_SQL, STYLE_IMPORT_SQL, q
from glyphledger.operators import lineage as ln
from glyphledger.operators import publish as pb
from glyphledger.operators import quality as qa
from glyphledger.operators import resolution as rs
from glyphledger.operators import styles
from glyphledger.operators import usage as us
from glyphledger.operators.similarity import outlines_by_asset
from glyphledger.session import materialize
from glyphledger.sources.files import (
    USAGE_EXCLUDED_DIRS,
    USAGE_EXTS,
    sniff_assets,
    wanted_file,
)

part(
    "code_line_fx",
    """SELECT project, path AS file, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS line, unnest(string_split(content, chr(10))) AS text
FROM repo_fx WHERE regexp_matches(lower(path), '\\.(vue|html|htm|js|jsx|ts|tsx)$') AND path NOT LIKE 'node_modules/%'""",
)


def _tokens(outer: str, group: int, auto: str) -> str:
    return f"""SELECT project, file, line, unnest(regexp_extract_all(v, {q(ICON_TOK)})) AS icon_name, {auto} AS auto FROM (
  SELECT project, file, line, unnest(regexp_extract_all(text, {q(outer)}, {group})) AS v FROM code_line_fx)"""


part("use_fx", f"{_tokens(ICON_ATTR, 1, 'true')} UNION ALL {_tokens(ICON_DYN, 0, 'false')}")
part(
    "ref_fx",
    f"""SELECT project, file, line, unnest(range(len(f))) AS seq, unnest(f) AS url FROM (SELECT project, file, line,
  list_concat(regexp_extract_all(text, {q(LINK_SQL)}, 1), regexp_extract_all(text, {q(STYLE_IMPORT_SQL)}, 1)) AS f FROM code_line_fx)""",
)
part(
    "use_count_fx",
    """SELECT project, icon_name, count(*) FILTER (auto) AS static_count, count(*) FILTER (NOT auto) AS dynamic_count, count(*) AS usage_count
FROM use_fx GROUP BY 1, 2""",
)


def _files(spark, sf):
    kept = wanted_file(F.col("path"), USAGE_EXTS, USAGE_EXCLUDED_DIRS, (), None)
    return view(spark, sf, "repo_fx").filter(kept)


def _lines(spark, sf):
    return us.lines(_files(spark, sf))


def _usage(spark, sf):
    w = world(spark, sf)
    if not hasattr(w, "_usage"):
        w._usage = materialize(us.scan_usage(_lines(spark, sf)))
    return w._usage


def _refs(spark, sf):
    w = world(spark, sf)
    if not hasattr(w, "_refs"):
        w._refs = materialize(us.css_refs(_lines(spark, sf)))
    return w._refs


@query("L1", "SELECT * FROM use_count_fx")
def usage_by_name(spark, sf):
    return us.usage_index(us.scan_usage(_lines(spark, sf)))


@query(
    "L1",
    """WITH hit AS (SELECT project FROM use_fx UNION SELECT project FROM ref_fx)
SELECT (SELECT count(DISTINCT (project, file)) FROM code_line_fx WHERE project IN (SELECT project FROM hit)) AS total_files,
  (SELECT count(*) FROM hit) AS total_projects, (SELECT count(*) FROM use_fx) AS total_usages""",
)
def usage_totals(spark, sf):
    return us.usage_totals(_files(spark, sf), _usage(spark, sf), _refs(spark, sf))


part(
    "owner_fx",
    "SELECT glyph_hash, project, count(*) AS copies FROM source_fx JOIN asset_project_fx USING (asset_id) GROUP BY 1, 2",
)
part(
    "lineage_fx",
    """SELECT o.glyph_hash, o.project, e.name, o.copies, coalesce(r.n, 0) AS css_refs, o.copies * coalesce(u.static_count, 0) AS auto_usages, o.copies * coalesce(u.dynamic_count, 0) AS manual_usages
FROM owner_fx o JOIN entry_fx e ON e.glyph_hash = o.glyph_hash LEFT JOIN (SELECT project, count(*) AS n FROM ref_fx GROUP BY 1) r ON r.project = o.project
LEFT JOIN use_count_fx u ON u.project = o.project AND u.icon_name = e.name
WHERE o.project IN (SELECT project FROM use_fx UNION SELECT project FROM ref_fx)""",
)
part(
    "flag_fx",
    """SELECT e.glyph_hash, f.final_hex AS new_hex, f.final_name AS new_name, f.final_name IS DISTINCT FROM e.name AS name_changed, f.final_hex IS DISTINCT FROM e.code_hex AS code_changed,
  (SELECT count(DISTINCT n) FROM (SELECT e.name AS n UNION SELECT alias FROM alias_fx a WHERE a.glyph_hash = e.glyph_hash) WHERE n <> '') AS old_names,
  coalesce(m.n, 0)::BIGINT AS manual_checks
FROM entry_fx e JOIN final_fx f ON f.glyph_hash = e.glyph_hash LEFT JOIN (SELECT glyph_hash, sum(manual_usages) AS n FROM lineage_fx GROUP BY 1) m ON m.glyph_hash = e.glyph_hash""",
)


def _links(w):
    return ln.project_links(w.reg.entries, w.reg.sources, w.asset_projects)


def _lineage(spark, sf):
    w = world(spark, sf)
    return ln.enhance_lineage(
        w.reg.entries, _links(w), us.usage_index(_usage(spark, sf)), _refs(spark, sf)
    )


def _flags(spark, sf):
    w = world(spark, sf)
    return ln.replacement_flags(
        w.reg.entries, w.reg.aliases, shared_resolution(w).glyphs, _lineage(spark, sf)
    )


@query("L2", "SELECT * FROM lineage_fx")
def lineage_usage(spark, sf):
    return _lineage(spark, sf)


@query("L3", "SELECT * FROM flag_fx")
def replacement_flags(spark, sf):
    return _flags(spark, sf)


@query(
    "L3",
    """SELECT glyph_hash, name AS old_name FROM entry_fx WHERE name <> '' UNION SELECT glyph_hash, alias FROM alias_fx WHERE alias <> ''""",
)
def old_names(spark, sf):
    w = world(spark, sf)
    return ln.old_names(w.reg.entries, w.reg.aliases)


@query(
    "L3",
    "SELECT project, icon_name AS name, file, line::INT AS line FROM use_fx WHERE NOT auto AND (project, icon_name) IN (SELECT (project, name) FROM lineage_fx WHERE manual_usages > 0)",
)
def manual_checks(spark, sf):
    return ln.manual_checks(_lineage(spark, sf), _usage(spark, sf))


@query(
    "L4",
    """SELECT glyph_hash, 'phase4' AS phase, code_hex, name, NULL AS reason FROM entry_fx
UNION ALL SELECT glyph_hash, 'phase7', new_hex, new_name, 'resolved' FROM flag_fx WHERE code_changed""",
)
def version_history(spark, sf):
    return ln.version_history(world(spark, sf).reg.entries, _flags(spark, sf))


@query(
    "L5",
    """WITH place AS (SELECT project, icon_name, list(file || ':' || line ORDER BY k) AS l FROM (
  SELECT *, row_number() OVER (PARTITION BY project, icon_name ORDER BY file, line, auto DESC) AS k FROM use_fx) WHERE k <= 10 GROUP BY 1, 2)
SELECT v.group_id, v.pos, v.glyph_hash, n.project, coalesce(n.auto_usages, 0) AS static_count, coalesce(n.manual_usages, 0) AS dynamic_count,
  coalesce(array_to_string(flatten([p.l for i in range(least(n.copies, 10))])[:10], ', '), '') AS places,
  f.final_name IS NOT NULL AS in_final, coalesce(f.final_name, '') AS final_name, coalesce(f.final_hex, '') AS preview_hex
FROM variant_fx v LEFT JOIN lineage_fx n ON n.glyph_hash = v.glyph_hash LEFT JOIN place p ON p.project = n.project AND p.icon_name = n.name
LEFT JOIN final_fx f ON f.glyph_hash = v.glyph_hash WHERE v.type <> 'glyph_duplicate'""",
)
def review_enrichment(spark, sf):
    w = world(spark, sf)
    open_variants = w.variants.filter(F.col("type") != "glyph_duplicate")
    return ln.enrich_review(
        open_variants, _lineage(spark, sf), _usage(spark, sf), shared_resolution(w).glyphs
    )


# ---------------------------------------------------------------- publishing

part(
    "geo_fx",
    """SELECT f.* EXCLUDE (advance_width, glyph_type), g.adv AS advance_width, coalesce(g.outline, false) AS outline,
  CASE WHEN coalesce(f.final_code, 0) = 0 THEN 'no_code' WHEN NOT coalesce(g.outline, false) THEN 'no_contours' END AS skip
FROM final_fx f LEFT JOIN (SELECT s.glyph_hash, arg_min(b.adv, s.at) AS adv, arg_min(b.outline, s.at) AS outline
  FROM final_source_fx s JOIN by_asset_fx b ON b.glyph_hash = s.glyph_hash AND b.asset_id = s.asset_id GROUP BY 1) g ON g.glyph_hash = f.glyph_hash""",
)
part("pub_fx", "SELECT * FROM geo_fx WHERE skip IS NULL")


def _geo(w):
    if not hasattr(w, "_geo"):
        w._geo = materialize(pb.with_geometry(shared_resolution(w), outlines_by_asset(w.glyphs)))
    return w._geo


def _pub(w):
    return pb.publishable(_geo(w))


@query("L6", "SELECT glyph_hash, final_code, final_name, advance_width, skip FROM geo_fx")
def publish_selection(spark, sf):
    w = world(spark, sf)
    geo = pb.with_geometry(shared_resolution(w), outlines_by_asset(w.glyphs))
    return geo.select("glyph_hash", "final_code", "final_name", "advance_width", "skip")


@query(
    "L6",
    """SELECT count(*) AS total, count(*) FILTER (skip IS NULL) AS published, count(*) FILTER (skip = 'no_code') AS no_code,
  count(*) FILTER (skip = 'no_contours') AS no_contours, 0::BIGINT AS composite FROM geo_fx""",
)
def publish_counts(spark, sf):
    return pb.publish_counts(_geo(world(spark, sf)))


def _css(prefix: str) -> str:
    return f"""SELECT {prefix} AS class_name, code_hex, kind FROM (
  SELECT final_name AS n, final_hex AS code_hex, 'name' AS kind FROM pub_fx WHERE final_name <> ''
  UNION ALL SELECT a.alias, p.final_hex, 'alias' FROM pub_fx p JOIN final_alias_fx a ON a.glyph_hash = p.glyph_hash WHERE a.alias <> '' AND a.alias <> p.final_name)"""


@query("L7", _css("'icon-' || n"))
def stylesheet_rows(spark, sf):
    w = world(spark, sf)
    return pb.css_rows(_pub(w), shared_resolution(w).aliases)


@query("L7", _css("CASE WHEN n LIKE 'icon-%' THEN n ELSE 'icon-' || n END"))
def stylesheet_rows_single_prefix(spark, sf):
    w = world(spark, sf)
    return pb.css_rows(_pub(w), shared_resolution(w).aliases, "dedupe")


@query(
    "L8",
    """SELECT p.glyph_hash, p.final_hex, p.final_name, p.resolution, s.asset_id, printf('%04X', coalesce(s.original_code, 0)) AS original_hex, coalesce(a.css_url, '') AS css_url, coalesce(a.ttf_path, '') AS ttf_path
FROM pub_fx p LEFT JOIN final_source_fx s ON s.glyph_hash = p.glyph_hash LEFT JOIN asset_fx a ON a.asset_id = s.asset_id""",
)
def merge_manifest(spark, sf):
    w = world(spark, sf)
    return pb.merge_manifest(_pub(w), shared_resolution(w).sources, w.assets)


@query(
    "L9",
    """SELECT (SELECT count(*) FROM pub_fx) AS total_glyphs, (SELECT count(*) FROM final_alias_fx WHERE glyph_hash IN (SELECT glyph_hash FROM pub_fx)) AS total_aliases,
  (SELECT count(DISTINCT asset_id) FROM final_source_fx WHERE glyph_hash IN (SELECT glyph_hash FROM pub_fx)) AS total_sources""",
)
def manifest_totals(spark, sf):
    w = world(spark, sf)
    res = shared_resolution(w)
    return pb.manifest_totals(_pub(w), res.aliases, res.sources)


part(
    "touched_fx",
    """SELECT DISTINCT f.glyph_hash, p.project FROM final_fx f JOIN item_source_fx s ON s.phase = f.phase AND s.k1 = f.k1 AND s.k2 = f.k2
JOIN asset_project_fx p ON p.asset_id = s.asset_id WHERE f.phase < 2""",
)
part(
    "package_fx",
    """SELECT p.glyph_hash, p.final_name AS name, p.final_hex AS code_hex, (SELECT count(*) FROM final_alias_fx a WHERE a.glyph_hash = p.glyph_hash) AS aliases, coalesce(j.n, 0) AS projects, p.resolution
FROM pub_fx p LEFT JOIN (SELECT glyph_hash, count(*) AS n FROM touched_fx GROUP BY 1) j ON j.glyph_hash = p.glyph_hash
WHERE final_name <> '' AND final_hex <> ''""",
)


def _projects(w):
    if not hasattr(w, "_projects"):
        w._projects = materialize(
            rs.affected_projects(shared_resolution(w).glyphs, shared_members(w), w.reg.sources, w.asset_projects)
        )
    return w._projects


@query("L10", "SELECT * FROM package_fx")
def package_rows(spark, sf):
    w = world(spark, sf)
    return pb.package_rows(_pub(w), shared_resolution(w).aliases, _projects(w))


@query(
    "L10",
    """SELECT count(*) AS total, count(*) FILTER (('0x' || code_hex)::BIGINT >= 57344 AND ('0x' || code_hex)::BIGINT < 58880) AS newly_assigned,
  count(*) FILTER (NOT (('0x' || code_hex)::BIGINT >= 57344 AND ('0x' || code_hex)::BIGINT < 58880)) AS original, sum(aliases)::BIGINT AS aliases,
  (SELECT count(DISTINCT project) FROM touched_fx WHERE glyph_hash IN (SELECT glyph_hash FROM package_fx)) AS projects FROM package_fx""",
)
def package_statistics(spark, sf):
    w = world(spark, sf)
    rows = pb.package_rows(_pub(w), shared_resolution(w).aliases, _projects(w))
    return pb.package_stats(rows, _projects(w))


part(
    "shared_fx",
    "SELECT s.asset_id, s.glyph_hash, count(*) OVER (PARTITION BY s.glyph_hash) AS n FROM final_source_fx s WHERE s.glyph_hash IN (SELECT glyph_hash FROM pub_fx)",
)


@query(
    "L11",
    'SELECT asset_id, count(*) FILTER (n > 1) AS shared, count(*) FILTER (n <= 1) AS "unique" FROM shared_fx GROUP BY 1',
)
def source_breakdown(spark, sf):
    w = world(spark, sf)
    return pb.source_breakdown(_pub(w), shared_resolution(w).sources)


@query(
    "L11",
    """SELECT count(*) FILTER (glyph_hash IN (SELECT glyph_hash FROM shared_fx WHERE n > 1)) AS shared,
  count(*) FILTER (glyph_hash NOT IN (SELECT glyph_hash FROM shared_fx WHERE n > 1)) AS "unique" FROM pub_fx""",
)
def shared_totals(spark, sf):
    w = world(spark, sf)
    return pb.shared_totals(_pub(w), shared_resolution(w).sources)


# ---------------------------------------------------------------- rewrite plan

part(
    "changed_fx",
    """SELECT g.glyph_hash, g.new_name, e.name, e.ord_major, o.project, o.copies FROM flag_fx g JOIN entry_fx e ON e.glyph_hash = g.glyph_hash
JOIN owner_fx o ON o.glyph_hash = g.glyph_hash WHERE g.name_changed OR g.code_changed""",
)
part(
    "rename_fx",
    """SELECT project, name AS src, new_name AS dst, copies, ord_major, glyph_hash, min(new_name) OVER w <> max(new_name) OVER w AS ambiguous
FROM changed_fx WHERE name <> '' AND new_name <> '' AND name <> new_name WINDOW w AS (PARTITION BY project, name)""",
)
part(
    "plan_fx",
    """SELECT project, file, line::INT AS line, arg_min(url, seq) AS "from", 'iconfont_merged.css' AS "to", 'css_link' AS type, 1::BIGINT AS copies, false AS ambiguous, NULL::BIGINT AS om, NULL AS oh
FROM ref_fx WHERE project IN (SELECT project FROM changed_fx) GROUP BY project, file, line
UNION ALL SELECT u.project, u.file, u.line::INT, u.icon_name, r.dst, 'icon_class', r.copies * u.hits, r.ambiguous, r.ord_major, r.glyph_hash
FROM (SELECT project, file, line, icon_name, count(*) AS hits FROM use_fx WHERE auto GROUP BY ALL) u JOIN rename_fx r ON r.project = u.project AND r.src = u.icon_name""",
)


def _rules(spark, sf):
    w = world(spark, sf)
    if not hasattr(w, "_rules"):
        made = _fresh_rules(spark, sf)
        w._rules = ln.RewriteRules(materialize(made.css), materialize(made.places), materialize(made.renames))
    return w._rules


def _fresh_rules(spark, sf):
    w = world(spark, sf)
    changes = ln.final_changes(w.reg.entries, shared_resolution(w).glyphs)
    return ln.rewrite_rules(w.reg.entries, _links(w), changes, _usage(spark, sf), _refs(spark, sf))


@query("L12", 'SELECT project, file, line, "from", "to", type, copies, ambiguous FROM plan_fx')
def rewrite_plan(spark, sf):
    return _fresh_rules(spark, sf).listing().drop("rule_ord")


@query(
    "L13",
    """SELECT project, coalesce(sum(copies) FILTER (type = 'icon_class'), 0)::BIGINT AS class_rules, count(*) FILTER (type = 'css_link') AS css_rules FROM plan_fx GROUP BY 1""",
)
def plan_summary(spark, sf):
    return _rules(spark, sf).summary()


@query(
    "L12",
    'SELECT project, src AS "from", count(*) AS fingerprints, sum(copies)::BIGINT AS copies, count(DISTINCT dst) AS targets, bool_or(ambiguous) AS ambiguous FROM rename_fx GROUP BY 1, 2',
)
def rename_rule_counts(spark, sf):
    """The rules of the plan in parts: one row per project and name, however many places it has."""
    w = world(spark, sf)
    changes = ln.final_changes(w.reg.entries, shared_resolution(w).glyphs)
    return ln.rename_counts(w.reg.entries, _links(w), changes)


@query(
    "L13",
    """SELECT project, k::INT AS rank, file, line, "from", "to" FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY om, oh, file, line, "from", "to", copy) AS k FROM (
  SELECT *, unnest(range(least(copies, 50))) AS copy FROM plan_fx WHERE type = 'icon_class')) WHERE k <= 50""",
)
def plan_preview(spark, sf):
    return _rules(spark, sf).preview()


part(
    "patched_fx",
    r"""SELECT project, file, line, before, after FROM (SELECT l.project, l.file, l.line::INT AS line, l.text AS before, list_reduce(p.rules, lambda acc, r:
    CASE WHEN split_part(r, chr(1), 1) = 'css_link' THEN
      CASE WHEN instr(acc, split_part(r, chr(1), 2)) > 0 THEN substr(acc, 1, instr(acc, split_part(r, chr(1), 2)) - 1) || split_part(r, chr(1), 3) || substr(acc, instr(acc, split_part(r, chr(1), 2)) + length(split_part(r, chr(1), 2))) ELSE acc END
    ELSE regexp_replace(acc, '\b' || split_part(r, chr(1), 2) || '\b', split_part(r, chr(1), 3), 'g') END, l.text) AS after
  FROM code_line_fx l JOIN (SELECT project, file, line, list(type || chr(1) || "from" || chr(1) || "to" ORDER BY type = 'icon_class', om, oh) AS rules FROM plan_fx GROUP BY 1, 2, 3) p
  ON p.project = l.project AND p.file = l.file AND p.line = l.line) WHERE before <> after""",
)


@query("L14", "SELECT * FROM patched_fx")
def plan_dry_run(spark, sf):
    return ln.apply_plan(_files(spark, sf), _rules(spark, sf))


@query(
    "L14",
    """SELECT l.project, l.file, sha256(string_agg(coalesce(p.after, l.text), chr(10) ORDER BY l.line)) AS digest FROM code_line_fx l
LEFT JOIN patched_fx p ON p.project = l.project AND p.file = l.file AND p.line = l.line
WHERE (l.project, l.file) IN (SELECT (project, file) FROM patched_fx) GROUP BY 1, 2""",
)
def patched_files(spark, sf):
    done = ln.patched_files(_files(spark, sf), _rules(spark, sf))
    return done.select("project", "file", F.sha2("content", 256).alias("digest"))


# ---------------------------------------------------------------- quality

part(
    "valid_fx",
    """SELECT asset_id, css_size, ttf_size, ttf_exists, mapping_count, CASE WHEN corrupt THEN 'ttf_corrupt' WHEN NOT expects THEN 'css_404' WHEN gone THEN 'ttf_missing' WHEN m = 0 THEN 'empty_mappings' ELSE 'ok' END AS status,
  expects AND m = 0 AS empty_map, concat_ws(';', CASE WHEN css_path IS NULL THEN 'css_path_missing' WHEN cs IS NULL THEN 'css_file_missing' END,
    CASE WHEN corrupt THEN 'ttf_corrupt: ' || reason END, CASE WHEN gone THEN 'ttf_file_missing' END, CASE WHEN gone THEN 'ttf_not_downloaded' END, CASE WHEN expects AND m = 0 THEN 'empty_mappings' END) AS issues
FROM (SELECT asset_id, css_path, css_size AS cs, coalesce(css_size, 0) AS css_size, CASE WHEN font_exists AND ttf_path IS NOT NULL THEN size ELSE 0 END AS ttf_size,
    font_exists AND ttf_path IS NOT NULL AS ttf_exists, download_status <> 'css_404' AS expects, mapping_count AS m, CASE WHEN download_status <> 'css_404' THEN mapping_count ELSE 0 END AS mapping_count,
    ttf_path IS NOT NULL AND NOT font_exists AS gone,
    ttf_path IS NOT NULL AND font_exists AND NOT (size >= 1024 AND header IN ('00010000','74727565','4F54544F')) AS corrupt,
    CASE WHEN size < 1024 THEN 'file_too_small' WHEN header LIKE '774F%' THEN 'wrong_format_is_woff' ELSE 'invalid_ttf_header' END AS reason FROM binary_fx)""",
)


def _checked(spark, sf):
    rows = view(spark, sf, "binary_fx")
    there = rows.filter(F.col("font_exists") & F.col("ttf_path").isNotNull())
    return qa.validate_assets(
        rows.select("asset_id", "css_path", "css_size", "ttf_path", "download_status"),
        rows.select("asset_id", "mapping_count"),
        sniff_assets(there.select("asset_id", "size", "header")),
    )


@query("V1", "SELECT asset_id, css_size, ttf_size, ttf_exists, mapping_count, issues, status FROM valid_fx")
def asset_validation(spark, sf):
    return _checked(spark, sf).withColumn("issues", F.array_join("issues", ";"))


@query(
    "V2",
    """SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'css_404') AS css_404, count(*) FILTER (status = 'ttf_missing') AS ttf_missing,
  count(*) FILTER (empty_map) AS empty_mappings, count(*) FILTER (status = 'ttf_corrupt') AS ttf_corrupt FROM valid_fx""",
)
def asset_status_counts(spark, sf):
    return qa.status_summary(_checked(spark, sf))


@query(
    "V3",
    """SELECT sum(mapping_count)::BIGINT AS total_mappings, min(mapping_count) AS min_mappings, max(mapping_count) AS max_mappings,
  floor(sum(mapping_count)::DOUBLE / count(*) + 0.5)::BIGINT AS avg_mappings, floor(sum(CASE WHEN ttf_exists THEN ttf_size END)::DOUBLE / 1024 + 0.5)::BIGINT AS total_kb FROM valid_fx WHERE status = 'ok'""",
)
def asset_mapping_statistics(spark, sf):
    return qa.mapping_stats(_checked(spark, sf))


@query(
    "V3",
    """(SELECT 'top' AS kind, asset_id, mapping_count FROM mapping_out ORDER BY mapping_count DESC, asset_id LIMIT 5)
UNION ALL (SELECT 'bottom', asset_id, mapping_count FROM mapping_out WHERE mapping_count = 0 ORDER BY asset_id LIMIT 5)""",
)
def asset_mapping_extremes(spark, sf):
    sheets = view(spark, sf, "sheet_fx")
    return qa.mapping_extremes(styles.mapping_status(sheets, sheets, styles.css_rules(sheets)))


@query(
    "V6",
    """SELECT (SELECT count(*) FROM (SELECT final_code FROM pub_fx GROUP BY 1 HAVING count(DISTINCT glyph_hash) > 1)) AS shared_codes,
  (SELECT count(*) FROM (SELECT final_name FROM pub_fx WHERE final_name <> '' GROUP BY 1 HAVING count(DISTINCT glyph_hash) > 1)) AS shared_names,
  (SELECT count(*) FROM entry_fx WHERE glyph_hash NOT IN (SELECT glyph_hash FROM geo_fx)) AS unaccounted_entries""",
)
def final_invariants(spark, sf):
    w = world(spark, sf)
    return qa.final_invariants(w.reg.entries, _geo(w))
