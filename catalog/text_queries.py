"""Scanning, extraction, dedup: queries and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import part, query
from catalog.fixtures import table, view
from glyphledger.functions import codes, text
from glyphledger.operators import links, styles, usage
from glyphledger.operators.glyphs import name_glyphs
from glyphledger.session import scratch_path
from glyphledger.sources import files, records

CDN, STATIC = ["cdn.example"], ["cdn.example", "static.example"]
ALIASES = {"static.example": "cdn.example"}
PATTERNS = links.link_patterns(CDN, STATIC)
HREF = [r'href="([^"]*)"']

# The link forms again, as the checks write them.
P_SQL = [
    r"(?:https?:)?//(?:cdn\.example)/t/(?:c/)?font_\d+_[a-zA-Z0-9]+\.(?:css|js)",
    r"(?:https?:)?//(?:cdn\.example|static\.example)/(?:ali-)?iconfont/font_\d+_[a-zA-Z0-9]+\.(?:css|eot|woff2?|ttf|svg)",
    r"(?:https?:)?//(?:cdn\.example|static\.example)/iconfont/\d+/css/symbols\.css",
    r"(?:https?:)?//(?:cdn\.example|static\.example)/[\w./-]*iconfont[\w./-]*\.css",
    r"(?:https?:)?//(?:cdn\.example|static\.example)/[\w./-]*font_\d+_[a-zA-Z0-9]+\.(?:eot|woff2?|ttf)",
]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm_sql(u: str, alias: bool = True) -> str:
    """URL normalisation in the checks' dialect."""
    a = f"(CASE WHEN trim({u}) LIKE '//%' THEN 'https:' || trim({u}) ELSE trim({u}) END)"
    b = f"(CASE WHEN {a} LIKE 'http://%' OR {a} LIKE 'https://%' THEN {a} ELSE 'https://' || {a} END)"
    if alias:
        b = f"replace({b}, 'https://static.example/', 'https://cdn.example/')"
    return rf"regexp_replace({b}, '([^:]/)/+', '\1', 'g')"


# ---------------------------------------------------------------- sources and sinks


@query("S1 S8", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def records_round_trip(spark, sf):
    path = scratch_path(spark, "records") + ".jsonl"
    part_df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    records.write_records(part_df, path, ["p_partkey"])
    return records.load_records(
        spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    )


@query("S1", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def array_records(spark, sf):
    """JSON arrays of a hundred records at most, as record tables are kept, read back as one table."""
    path = scratch_path(spark, "arrays") + ".json"
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    arrays = rows.groupBy((F.col("s_suppkey") / 100).cast("int").alias("batch")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.write.partitionBy("batch").text(path)
    return records.load_records(spark, f"{path}/*", "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


ASSET_TEXT = "concat(CASE s_suppkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'OTTO' ELSE 'wOFF' END, repeat('x', cast(s_suppkey * 37 % 1500 AS int)))"


@query(
    "S3",
    """SELECT s_suppkey, size, valid, reason FROM (SELECT *, reason IS NULL AS valid FROM (
  SELECT s_suppkey, 4 + s_suppkey * 37 % 1500 + 1 AS size, CASE WHEN 4 + s_suppkey * 37 % 1500 + 1 < 1024 THEN 'file_too_small' WHEN s_suppkey % 3 = 2 THEN 'wrong_format_is_woff' END AS reason FROM supplier))""",
)
def asset_files(spark, sf):
    """A binary file a supplier, written from the table; size and header are read from the files.

    The files are dealt over all tasks, and a folder holds those of a thousand keys, so neither
    the writing nor the listing of many small files waits for one task or for the driver.
    """
    root = scratch_path(spark, "assets")
    rows = table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey div 1000 AS string) AS project",
        "concat('s_suppkey=', cast(s_suppkey AS string), '.ttf') AS path",
        f"concat({ASSET_TEXT}, '\n') AS content",
    )
    _write_tree(rows.repartition(spark.sparkContext.defaultParallelism, "path"), root)
    found = files.sniff_assets(files.read_assets(spark, root))
    key = F.regexp_extract("path", r"s_suppkey=(-?\d+)\.ttf", 1).cast("long")
    return found.select(key.alias("s_suppkey"), "size", "valid", "reason")


@query(
    "S2",
    r"""SELECT project, path FROM path_fx
WHERE NOT regexp_matches(path, '(^|/)(node_modules|\.git|\.svn|dist|out|\.next|\.nuxt|\.svelte-kit|\.cache|\.tmp|\.vscode|\.idea|tests|docs|mock)/')
  AND (regexp_matches(lower(path), '[^/.][^/]*\.(html|ejs|pug|hbs|css|scss|less|styl|js|ts|jsx|tsx|vue|svelte)$')
       OR regexp_matches(path, '(^|/)\.env[^/]*$'))""",
)
def source_file_filter(spark, sf):
    return view(spark, sf, "path_fx").filter(files.wanted_file(F.col("path"))).select("project", "path")


TREE_PATH = """concat(CASE doc_id % 5 WHEN 0 THEN 'src/' WHEN 1 THEN '_inc/' WHEN 2 THEN '.conf/deep/' WHEN 3 THEN 'node_modules/m/' ELSE '' END,
  CASE doc_id % 3 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END, 'd', cast(doc_id AS {text}), CASE doc_id % 4 WHEN 3 THEN '.md' ELSE '.scss' END)"""


def _write_tree(rows, root):
    """Write (project, path, content) as files; a task that runs again writes the same files again."""

    def write(batches):
        store, top = files.open_store(root)
        for pdf in batches:
            for project, path, content in zip(pdf["project"], pdf["path"], pdf["content"], strict=True):
                full = f"{top}/{project}/{path}"
                store.create_dir(full.rsplit("/", 1)[0])
                with store.open_output_stream(full, compression=None) as f:
                    f.write(content.encode())
            yield pdf[["path"]]

    rows.mapInPandas(write, "path string").agg(F.count(F.lit(1))).collect()


@query(
    "S2",
    f"""SELECT project, path, ext, md5(content) AS content_md5, length(content) AS chars FROM (
  SELECT source AS project, {TREE_PATH.format(text='varchar')} AS path, '.scss' AS ext, text AS content FROM documents
  WHERE text IS NOT NULL AND source IS NOT NULL AND doc_id % 4 <> 3 AND doc_id % 5 <> 3)""",
)
def source_tree(spark, sf):
    """Every text as a file of its source's tree, many with a name or folder that listings leave out, read back."""
    root = scratch_path(spark, "tree")
    docs = table(spark, sf, "documents").filter("text IS NOT NULL AND source IS NOT NULL")
    _write_tree(docs.selectExpr("source AS project", f"{TREE_PATH.format(text='string')} AS path", "text AS content"), root)
    return files.scan_files(spark, root).select("project", "path", "ext", F.md5("content").alias("content_md5"), F.char_length("content").alias("chars"))


@query(
    "S3",
    """SELECT asset_id, size, header,
  CASE WHEN size < 1024 THEN 'file_too_small' WHEN header IN ('00010000','74727565','4F54544F') THEN NULL
       WHEN header IN ('774F4646','774F4632') THEN 'wrong_format_is_woff' ELSE 'invalid_ttf_header' END AS reason,
  size >= 1024 AND header IN ('00010000','74727565','4F54544F') AS valid
FROM binary_fx""",
)
def asset_header_check(spark, sf):
    return files.sniff_assets(view(spark, sf, "binary_fx").select("asset_id", "size", "header"))


part(
    "seed_fx",
    "SELECT DISTINCT concat('//static.example/', c_mktsegment, '//font_', c_custkey % 30, '_ab.css') AS url FROM customer"
    " UNION SELECT url FROM link_fx",
)
SEEDS = (
    "concat('//static.example/', c_mktsegment, '//font_', cast(c_custkey % 30 AS string), '_ab.css') AS url"
)


def _seeds(spark, sf):
    own = table(spark, sf, "customer").selectExpr(SEEDS)
    return own.union(view(spark, sf, "link_fx").select("url")).distinct()


@query(
    "S5",
    f"""SELECT url, project FROM index_exact
UNION ALL SELECT DISTINCT {norm_sql('url')}, 'manual' FROM seed_fx
WHERE {norm_sql('url')} NOT IN (SELECT url FROM index_exact)""",
)
def seed_links(spark, sf):
    index = links.link_index(view(spark, sf, "link_fx"))
    return links.add_seeds(index, _seeds(spark, sf), ALIASES)


@query(
    "S6",
    """WITH entry_rows AS (
  SELECT file_ord, i AS pos, json_extract(body, '$[' || i || ']') AS e FROM export_fx, range(3) r(i)),
picked AS (SELECT json_extract_string(e, '$.project.name') AS name, json_extract_string(e, '$.project.web_url') AS web_url,
  row_number() OVER (PARTITION BY json_extract_string(e, '$.project.web_url') ORDER BY file_ord, pos) AS k
  FROM entry_rows WHERE json_extract_string(e, '$.type') = 'Project' AND json_extract_string(e, '$.project.web_url') IS NOT NULL)
SELECT coalesce(name, 'unknown') AS name, web_url,
  'git@' || split_part(replace(web_url, 'https://', ''), '/', 1) || ':' || regexp_replace(replace(web_url, 'https://', ''), '^[^/]*/', '') || '.git' AS clone_url
FROM picked WHERE k = 1""",
)
def export_project_list(spark, sf):
    return files.export_projects(view(spark, sf, "export_fx"))


@query("S7", "SELECT project, count(*) AS files, sum(length(content))::BIGINT AS chars FROM repo_fx GROUP BY project")
def project_partitions(spark, sf):
    path = scratch_path(spark, "by-project")
    records.write_by_project(view(spark, sf, "repo_fx"), path)
    back = spark.read.parquet(path)
    return back.groupBy("project").agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.length("content")).alias("chars")
    )


# ---------------------------------------------------------------- text

part(
    "no_markup",
    "SELECT project, path, ext, ord, content, regexp_replace(content, '<!--[\\s\\S]*?-->', ' ', 'g') AS t FROM comment_fx",
)
part(
    "comment_fx",
    "SELECT project, path, ext, ord, content FROM page_file_fx UNION ALL SELECT project, path, ext, ord, content FROM repo_fx",
)
# Blocks between tags are cut out by position: a file here has at most one script and one style block.
part(
    "stripped_fx",
    r"""SELECT project, path, ext, ord, CASE
  WHEN ext IN ('.html', '.vue') THEN
    regexp_extract(t, '(?i)^([\s\S]*?<script[\s\S]*?>|[\s\S]*)', 1) ||
    CASE WHEN regexp_matches(t, '(?i)<script[\s\S]*?>[\s\S]*?</script>') THEN
      regexp_replace(regexp_replace(regexp_extract(t, '(?i)<script[\s\S]*?>([\s\S]*?)</script>', 1), '/\*[\s\S]*?\*/', ' ', 'g'), '(^|[^:"''])//[^\n]*', '\1 ', 'g')
      || regexp_replace(regexp_extract(t, '(?i)<script[\s\S]*?>[\s\S]*?(</script>[\s\S]*)$', 1), '(?i)(<style[\s\S]*?>[\s\S]*?)/\*[\s\S]*?\*/', '\1 ', 'g')
    ELSE '' END
  WHEN ext = '.js' THEN regexp_replace(regexp_replace(content, '/\*[\s\S]*?\*/', ' ', 'g'), '(^|[^:"''`])//[^\n]*', '\1 ', 'g')
  WHEN ext = '.css' THEN regexp_replace(content, '/\*[\s\S]*?\*/', ' ', 'g')
  ELSE content END AS s FROM no_markup""",
)


def _comment_files(spark, sf):
    cols = ["project", "path", "ext", "ord", "content"]
    return view(spark, sf, "page_file_fx").select(*cols).union(view(spark, sf, "repo_fx").select(*cols))


@query(
    "X1",
    r"""SELECT project, path, sha256(regexp_replace(s, ' +', ' ', 'g')) AS digest,
  length(content) AS chars FROM stripped_fx JOIN comment_fx USING (project, path, ord)""",
)
def comment_stripping(spark, sf):
    stripped = text.strip_comments(F.col("content"), F.col("ext"))
    # Runs of blanks are collapsed only for the check; the length shows that offsets were kept.
    return _comment_files(spark, sf).select(
        "project",
        "path",
        F.sha2(F.regexp_replace(stripped, " +", " "), 256).alias("digest"),
        F.length(stripped).cast("long").alias("chars"),
    )


part(
    "paths_out",
    r"""SELECT project,
  coalesce(lit, nullif(replace(defd, '$' || '{pkg.name}', pkg), ''), replace(prod, '$' || '{pkg.name}', pkg)) AS public_path,
  replace(assets, '$' || '{pkg.name}', pkg) AS assets_path
FROM (SELECT project, pkg,
    nullif(regexp_extract(vue, 'publicPath\s*:\s*[''"`]([^''"`]+)[''"`]', 1), '') AS lit,
    CASE WHEN regexp_matches(vue, 'publicPath\s*:\s*base') THEN regexp_extract(vue, '(?:const|let|var)\s+base\s*=\s*[''"`](.*?)[''"`]', 1) END AS defd,
    nullif(regexp_extract(vue, 'assetsPublicPath_pro\s*=\s*[''"`](//cdn\.example[^''"`]+)[''"`]', 1), '') AS prod,
    nullif(regexp_extract(cfg, 'assetsPublicPath\s*:\s*[''"`](//static\.example[^''"`]*?)[''"`]', 1), '') AS assets
  FROM (SELECT project, json_extract_string(max(CASE WHEN path = 'package.json' THEN content END), '$.name') AS pkg,
      max(CASE WHEN path = 'vue.config.js' THEN content END) AS vue, max(CASE WHEN path = 'config/index.js' THEN content END) AS cfg
    FROM setting_fx GROUP BY project))""",
)


def _paths(spark, sf):
    return files.public_paths(
        view(spark, sf, "setting_fx"), "assetsPublicPath_pro", r"//cdn\.example", r"//static\.example"
    )


@query("X2", "SELECT * FROM paths_out")
def project_public_paths(spark, sf):
    return _paths(spark, sf)


@query(
    "X3",
    r"""SELECT project, path, CASE WHEN content NOT LIKE '%htmlWebpackPlugin%' THEN content ELSE
  regexp_replace(CASE WHEN public_path IS NULL THEN content ELSE regexp_replace(content, '<%=\s*htmlWebpackPlugin\.options\.path\s*%>', public_path, 'g') END,
    '<%=\s*htmlWebpackPlugin\.options\.assetsPublicPath\s*%>', coalesce(assets_path, '<%=htmlWebpackPlugin.options.assetsPublicPath%>'), 'g') END AS content
FROM setting_fx LEFT JOIN paths_out USING (project)""",
)
def template_expansion(spark, sf):
    return files.expand_templates(view(spark, sf, "setting_fx"), _paths(spark, sf))


@query(
    "X4",
    f"""SELECT DISTINCT project, path, {norm_sql('u')} AS url FROM (
  SELECT project, path, unnest(list_concat({', '.join(f'regexp_extract_all(s, {q(p)})' for p in P_SQL)})) AS u FROM stripped_fx)""",
)
def link_extraction(spark, sf):
    return links.extract_links(_comment_files(spark, sf), PATTERNS, ALIASES)


@query(
    "X4",
    f"""SELECT DISTINCT project, {norm_sql('u', False)} AS url FROM (
  SELECT project, unnest(regexp_extract_all(s, 'href="([^"]*)"', 1)) AS u FROM stripped_fx)""",
)
def project_link_sets(spark, sf):
    return links.project_links(links.extract_links(_comment_files(spark, sf), HREF, group=1))


# Settings without comments: only script files hold any, and those only line comments after a quote or colon.
BARE_SETTINGS = r"""SELECT project, path, CASE WHEN path LIKE '%.js' THEN
  regexp_replace(regexp_replace(content, '/\*[\s\S]*?\*/', '', 'g'), '(^|[^:''"`])//[^\n]*', '\1', 'g') ELSE content END AS content FROM setting_fx"""

IMPORT_SQL = r"""@import\s+(?:url\(\s*)?['"]?([^'")\s;]+iconfont[^'")\s;]*)['"]?\s*\)?\s*;"""
REMOTE_SQL = r"(u LIKE '//%' OR u LIKE 'http%') AND (lower(u) LIKE '%iconfont%' OR regexp_matches(u, 'font_\d+'))"


@query(
    "X5",
    f"""SELECT DISTINCT project, path, {norm_sql('u')} AS url FROM (
  SELECT project, path, unnest(regexp_extract_all(content, {q(IMPORT_SQL)}, 1)) AS u FROM ({BARE_SETTINGS})) WHERE {REMOTE_SQL}""",
)
def import_extraction(spark, sf):
    sheets = view(spark, sf, "setting_fx").withColumn("ext", text.extension(F.col("path")))
    return links.extract_imports(sheets, aliases=ALIASES)


FILLED_SETTINGS = r"""SELECT project, path, CASE WHEN content NOT LIKE '%htmlWebpackPlugin%' THEN content ELSE
  regexp_replace(CASE WHEN public_path IS NULL THEN content ELSE regexp_replace(content, '<%=\s*htmlWebpackPlugin\.options\.path\s*%>', public_path, 'g') END,
    '<%=\s*htmlWebpackPlugin\.options\.assetsPublicPath\s*%>', coalesce(assets_path, '<%=htmlWebpackPlugin.options.assetsPublicPath%>'), 'g') END AS content
FROM (BARE) s LEFT JOIN paths_out USING (project)""".replace("BARE", BARE_SETTINGS)


@query(
    "X3 X4 X5",
    f"""SELECT DISTINCT project, path, {norm_sql('u')} AS url FROM (
  SELECT project, path, unnest(list_concat({', '.join(f'regexp_extract_all(content, {q(p)})' for p in P_SQL)})) AS u FROM ({FILLED_SETTINGS}))
UNION SELECT DISTINCT project, path, {norm_sql('u')} FROM (
  SELECT project, path, unnest(regexp_extract_all(content, {q(IMPORT_SQL)}, 1)) AS u FROM ({FILLED_SETTINGS})) WHERE {REMOTE_SQL}""",
)
def templated_links(spark, sf):
    every = view(spark, sf, "setting_fx").withColumn("ext", text.extension(F.col("path")))
    hits = links.scan_links(every, PATTERNS)
    return links.hit_links(links.fill_links(hits, _paths(spark, sf), PATTERNS), aliases=ALIASES)


@query(
    "X6",
    f"""SELECT DISTINCT project, path, {norm_sql('u')} AS url FROM (
  SELECT project, path, unnest(regexp_extract_all(content, {q(links.URL_CALL)}, 1)) AS u FROM setting_fx WHERE path = 'dist/iconfont.css')
WHERE {REMOTE_SQL}
UNION SELECT DISTINCT project, path, {norm_sql('u')} FROM (
  SELECT project, path, unnest(list_concat({', '.join(f'regexp_extract_all(content, {q(p)})' for p in P_SQL)})) AS u FROM setting_fx WHERE path = 'dist/iconfont.css')
UNION SELECT DISTINCT project, path, {norm_sql('u')} FROM (
  SELECT project, path, unnest(regexp_extract_all(content, {q(IMPORT_SQL)}, 1)) AS u FROM setting_fx WHERE path = 'dist/iconfont.css') WHERE {REMOTE_SQL}""",
)
def local_stylesheet_links(spark, sf):
    every = view(spark, sf, "setting_fx").withColumn("ext", text.extension(F.col("path")))
    scanned = every.filter(files.wanted_file(F.col("path")))
    return links.follow_local(scanned, every, PATTERNS, aliases=ALIASES)


URL_FORMS = """CASE page_id % 6 WHEN 0 THEN concat('  ', url, '//x///y ') WHEN 1 THEN concat('//static.example//a', cast(page_id AS string))
  WHEN 2 THEN concat('static.example/b//', cast(page_id AS string)) WHEN 3 THEN 'http://static.example/c' ELSE url END"""


@query("X7", f"SELECT page_id, {norm_sql('u')} AS url FROM (SELECT page_id, {URL_FORMS} AS u FROM pages)")
def url_normalisation(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.normalize_url(F.expr(URL_FORMS), ALIASES).alias("url")
    )


REL_FORMS = """CASE page_id % 8 WHEN 0 THEN '../x/f.ttf' WHEN 1 THEN concat('./a/../../', cast(page_id AS string), '.ttf?q=1')
  WHEN 2 THEN '//h.example/p.ttf' WHEN 3 THEN '/abs/p.ttf' WHEN 4 THEN 'data:font/ttf;base64,AA' WHEN 5 THEN 'b/./c.ttf#k'
  WHEN 6 THEN '../../../../up.ttf' ELSE 'https://o.example/z.ttf' END"""


@query(
    "X8",
    rf"""SELECT page_id, CASE WHEN r LIKE '//%' THEN 'https:' || r WHEN r LIKE '/%' THEN o || r WHEN r LIKE 'http%' OR r LIKE 'data:%' THEN r
  ELSE o || list_reduce(list_concat([''], list_filter(string_split(d || split_part(split_part(r, '#', 1), '?', 1), '/'), lambda s: s <> '')),
    lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN s = '.' THEN acc ELSE acc || '/' || s END)
    || regexp_extract(r, '([?#].*)?$', 1) END AS url
FROM (SELECT page_id, {REL_FORMS} AS r, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS o,
  regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') AS d FROM pages)""",
)
def url_resolution(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.resolve_url(F.expr(REL_FORMS), F.col("url")).alias("url")
    )


part(
    "fonts_out",
    r"""SELECT asset_id, CASE WHEN css IS NULL THEN 'css_404' WHEN k IS NULL THEN 'no_ttf_url' ELSE 'found' END AS status,
  coalesce(k, 'ttf') AS font_format,
  CASE WHEN u LIKE '//%' THEN 'https:' || u WHEN u LIKE '/%' THEN 'https://cdn.example' || u WHEN u LIKE 'http%' THEN u
    WHEN u LIKE '../%' THEN 'https://cdn.example/a/' || substr(u, 4)
    ELSE regexp_extract(css_url, '^(.*/)', 1) || replace(u, './x/../', '') END AS font_url
FROM (SELECT asset_id, css, css_url, CASE WHEN ttf IS NOT NULL THEN 'ttf' WHEN w2 IS NOT NULL THEN 'woff2' WHEN w1 IS NOT NULL THEN 'woff' END AS k, coalesce(ttf, w2, w1) AS u
  FROM (SELECT asset_id, css, css_url,
    nullif(regexp_extract(css, '(?i)url\s*\(\s*["'']?([^"'')\s]+\.ttf(?:\?[^"'')\s]*)?)\s*["'']?\)', 1), '') AS ttf,
    nullif(regexp_extract(css, '(?i)url\s*\(\s*["'']?([^"'')\s]+\.woff2(?:\?[^"'')\s]*)?)\s*["'']?\)', 1), '') AS w2,
    nullif(regexp_extract(css, '(?i)url\s*\(\s*["'']?([^"'')\s]+\.woff(?:\?[^"'')\s]*)?)\s*["'']?\)', 1), '') AS w1 FROM sheet_fx))""",
)


@query("X9", "SELECT asset_id, status, font_format, font_url FROM fonts_out")
def stylesheet_font_url(spark, sf):
    return styles.font_url(view(spark, sf, "sheet_fx")).select("asset_id", "status", "font_format", "font_url")


@query("X10", "SELECT page_id, substr(sha256(url), 1, 12) AS asset_id FROM pages")
def url_asset_id(spark, sf):
    return table(spark, sf, "pages").select("page_id", codes.asset_id(F.col("url")).alias("asset_id"))


@query("X11", "SELECT doc_id, sha256(text) AS digest FROM documents")
def document_content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", codes.content_hash(F.col("text")).alias("digest"))


part(
    "rules_out",
    r"""SELECT asset_id, b, k, name, code_hex FROM (
  SELECT asset_id, b, k, code_hex, CASE
    WHEN regexp_matches(s, '^\.icon-([a-zA-Z0-9_-]+)(?::\w+)?$') THEN 'icon-' || regexp_extract(s, '^\.icon-([a-zA-Z0-9_-]+)', 1)
    WHEN regexp_matches(s, '^\.icon([A-Z][a-zA-Z0-9_-]*)(?::\w+)?$') THEN 'icon' || regexp_extract(s, '^\.icon([A-Z][a-zA-Z0-9_-]*)', 1)
    WHEN regexp_matches(s, '^\.s-([a-zA-Z0-9_-]+)(?::\w+)?$') THEN 's-' || regexp_extract(s, '^\.s-([a-zA-Z0-9_-]+)', 1) END AS name
  FROM (SELECT asset_id, b, code_hex, trim(unnest(string_split(sel, ','))) AS s, unnest(range(len(string_split(sel, ',')))) AS k
    FROM (SELECT asset_id, b, trim(sel, E' \n\t') AS sel, lower(regexp_extract(trim(body), 'content\s*:\s*["'']?\\([0-9a-fA-F]+)["'']?\s*(?:[;}]|$)', 1)) AS code_hex
      FROM (SELECT asset_id, unnest(range(len(regexp_extract_all(css, '([^{}]+?)\{([^}]*)\}')))) AS b,
          unnest(regexp_extract_all(css, '([^{}]+?)\{([^}]*)\}', 1)) AS sel, unnest(regexp_extract_all(css, '([^{}]+?)\{([^}]*)\}', 2)) AS body
        FROM sheet_fx)) WHERE code_hex <> '')) WHERE name IS NOT NULL""",
)


@query("X12", "SELECT asset_id, name, code_hex, '.' || name || ':before' AS selector FROM rules_out")
def stylesheet_rules(spark, sf):
    return styles.css_rules(view(spark, sf, "sheet_fx")).drop("ord")


part(
    "mapping_out",
    """SELECT s.asset_id, coalesce(n, 0) AS mapping_count,
  CASE WHEN css IS NULL THEN 'parse_error' WHEN n IS NULL THEN 'no_icons' ELSE 'ok' END AS extract_status
FROM sheet_fx s LEFT JOIN (SELECT asset_id, count(*) AS n FROM rules_out GROUP BY 1) r ON r.asset_id = s.asset_id
WHERE download_status <> 'css_404'""",
)


@query("X13", "SELECT * FROM mapping_out")
def stylesheet_mapping_status(spark, sf):
    sheets = view(spark, sf, "sheet_fx")
    return styles.mapping_status(sheets, sheets, styles.css_rules(sheets))


@query(
    "X14",
    """SELECT p_partkey, printf('%04X', p_size*1000) AS code_hex, p_size*1000 AS code FROM part""",
)
def code_hex_round_trip(spark, sf):
    hexed = codes.code_to_hex(F.col("p_size") * 1000)
    return table(spark, sf, "part").select(
        "p_partkey", hexed.alias("code_hex"), codes.hex_to_code(F.lower(hexed)).alias("code")
    )


part(
    "line_fx",
    """SELECT project, path AS file, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS line, unnest(string_split(content, chr(10))) AS text
FROM (SELECT project, path, content FROM page_file_fx UNION ALL SELECT project, path, content FROM repo_fx
      UNION ALL SELECT project, path, content FROM doc_file_fx)""",
)


def _lines(spark, sf, names=("page_file_fx", "repo_fx", "doc_file_fx")):
    out = None
    for n in names:
        df = view(spark, sf, n).select("project", "path", "content")
        out = df if out is None else out.union(df)
    return usage.lines(out)


@query("X15", "SELECT project, file, line::INT AS line, sha256(text) AS digest FROM line_fx")
def line_index(spark, sf):
    return _lines(spark, sf).select("project", "file", "line", F.sha2("text", 256).alias("digest"))


def _tok(kind: str, outer: str, group: int, tok: str, auto: str) -> str:
    return f"""SELECT project, file, line::INT AS line, instr(text, tok)::INT AS "column", sha256(trim(text, E' \\t\\r\\n')) AS context, tok AS icon_name,
  '{kind}' AS usage_type, {auto} AS can_auto_replace
FROM (SELECT project, file, line, text, unnest(regexp_extract_all(v, {q(tok)})) AS tok FROM (
  SELECT project, file, line, text, unnest(regexp_extract_all(text, {q(outer)}, {group})) AS v FROM line_fx))"""


AD = r"\bad\b"
AD_ATTR = r"""(?:class|:class)\s*=\s*["'`]([^"'`]*\bad\b[^"'`]*)["'`]"""
ICON_TOK = r"\bicon-[\w-]+\b"
ICON_ATTR = r"""(?:class|:class)\s*=\s*["'`]([^"'`]*\bicon-[\w-]+\b[^"'`]*)["'`]"""
ICON_DYN = r"""[`'"](?:[^`'"]*icon-[^`'"]*)[`'"]|\$\{[^}]*icon-[^}]*\}"""


def _shown(df):
    return df.withColumn("context", F.sha2("context", 256)).drop("seq")


@query("X16", _tok("static_class", AD_ATTR, 1, AD, "true"))
def static_class_usage(spark, sf):
    return _shown(usage.static_usage(_lines(spark, sf), "ad", ""))


@query("X16", _tok("static_class", ICON_ATTR, 1, ICON_TOK, "true"))
def static_icon_usage(spark, sf):
    return _shown(usage.static_usage(_lines(spark, sf)))


@query("X17", _tok("dynamic_class", ICON_DYN, 0, ICON_TOK, "false"))
def dynamic_icon_usage(spark, sf):
    return _shown(usage.dynamic_usage(_lines(spark, sf)))


LINK_SQL = r"""(?i)<link[^>]*rel=["']stylesheet["'][^>]*href=["']([^"']*iconfont[^"']*)["'][^>]*>"""
STYLE_IMPORT_SQL = r"""(?i)@import\s+["']([^"']*iconfont[^"']*)["']"""
part(
    "refs_fx",
    f"""SELECT project, file, line::INT AS line, text, unnest(range(len(f)))::INT AS seq, unnest(f) AS resolved_url FROM (
  SELECT project, file, line, text, list_concat(regexp_extract_all(text, {q(LINK_SQL)}, 1), regexp_extract_all(text, {q(STYLE_IMPORT_SQL)}, 1)) AS f FROM line_fx)""",
)


@query(
    "X18",
    r"SELECT project, file, line, seq, resolved_url, sha256(trim(text, E' \t\r\n')) AS raw_html FROM refs_fx",
)
def stylesheet_references(spark, sf):
    refs = usage.css_refs(_lines(spark, sf))
    return refs.withColumn("raw_html", F.sha2("raw_html", 256))


@query(
    "X19",
    f"""WITH l AS (SELECT DISTINCT project, path, {norm_sql('u')} AS url FROM (
  SELECT project, path, unnest(list_concat({', '.join(f'regexp_extract_all(s, {q(p)})' for p in P_SQL)})) AS u FROM stripped_fx)),
keys AS (SELECT url, min(project || path) AS o, regexp_extract(url, '([^/]*)$', 1) AS f FROM l WHERE url LIKE '%.css' OR url LIKE '%.js' GROUP BY url),
kept AS (SELECT url FROM (SELECT url, row_number() OVER (PARTITION BY f ORDER BY length(url), o) AS k FROM keys) WHERE k = 1)
SELECT url, project, path FROM l WHERE url IN (SELECT url FROM kept)""",
)
def link_mentions(spark, sf):
    found = links.extract_links(_comment_files(spark, sf), PATTERNS, ALIASES)
    ordered = found.select("url", F.concat("project", "path").alias("ord"))
    return links.link_files(found, links.dedup_links(ordered))


# ---------------------------------------------------------------- dedup

part(
    "keyed_fx",
    r"""SELECT project, url, ord, CASE WHEN regexp_matches(f, '(?i)^font_\d+_\w+\.css$') THEN f
    WHEN regexp_matches(p, '/\d{10,}/') THEN regexp_extract(p, '.*/(\d{10,})/', 1) || '/' || f ELSE f END AS dedup_key
FROM (SELECT project, url, ord, p, regexp_extract(p, '([^/]*)$', 1) AS f FROM (
  SELECT project, url, ord, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM link_fx))
WHERE regexp_matches(lower(f), '\.(css|js)$')""",
)
part(
    "winner_fx",
    "SELECT dedup_key, url, ord FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY length(url), ord) AS k FROM keyed_fx) WHERE k = 1",
)
part(
    "own_fx",
    "SELECT project, dedup_key, url, ord FROM (SELECT *, row_number() OVER (PARTITION BY project, dedup_key ORDER BY length(url), ord) AS k FROM keyed_fx) WHERE k = 1",
)
part(
    "index_exact",
    """SELECT w.url, o.project FROM (SELECT url FROM (SELECT url, row_number() OVER (PARTITION BY dedup_key ORDER BY length(url), ord) AS k FROM own_fx) WHERE k = 1) w
LEFT JOIN (SELECT DISTINCT project, url FROM own_fx) o ON o.url = w.url""",
)


@query("D1", "SELECT dedup_key, url, ord FROM winner_fx")
def link_dedup(spark, sf):
    return links.dedup_links(view(spark, sf, "link_fx"))


@query("D2", "SELECT url, project FROM index_exact")
def link_project_index(spark, sf):
    return links.link_index(view(spark, sf, "link_fx"))


@query(
    "D2",
    """SELECT w.url, o.project FROM (SELECT dedup_key, url FROM (SELECT dedup_key, url, row_number() OVER (PARTITION BY dedup_key ORDER BY length(url), ord) AS k FROM own_fx) WHERE k = 1) w
JOIN (SELECT DISTINCT project, dedup_key FROM own_fx) o USING (dedup_key)""",
)
def link_project_index_by_key(spark, sf):
    return links.link_index(view(spark, sf, "link_fx"), "by_key")


@query(
    "D3",
    "SELECT DISTINCT k.dedup_key, w.url AS kept, k.url AS dropped FROM keyed_fx k JOIN winner_fx w USING (dedup_key) WHERE k.url <> w.url",
)
def link_dedup_detail(spark, sf):
    return links.dedup_detail(view(spark, sf, "link_fx"))


@query(
    "D4",
    f"""WITH seeded AS (SELECT url, project FROM index_exact UNION ALL SELECT DISTINCT {norm_sql('url')}, 'manual' FROM seed_fx WHERE {norm_sql('url')} NOT IN (SELECT url FROM index_exact))
SELECT (SELECT count(DISTINCT project) FROM link_fx) AS total_projects,
  (SELECT count(DISTINCT project) FROM seeded WHERE project <> 'manual') AS projects_with_links,
  (SELECT count(*) FROM seed_fx) AS manual_links, (SELECT count(DISTINCT url) FROM seeded) AS unique_links""",
)
def link_coverage(spark, sf):
    found, seeds = view(spark, sf, "link_fx"), _seeds(spark, sf)
    index = links.add_seeds(links.link_index(found), seeds, ALIASES)
    return links.link_stats(found, index, seeds)


@query(
    "D4",
    """SELECT p.project, count(o.url) AS link_count FROM (SELECT DISTINCT project FROM link_fx) p
LEFT JOIN index_exact o ON o.project = p.project GROUP BY 1""",
)
def links_per_project(spark, sf):
    found = view(spark, sf, "link_fx")
    return links.links_per_project(found, links.link_index(found))


# ---------------------------------------------------------------- names


@query(
    "G1",
    """SELECT g.asset_id, g.code, r.name AS icon_name FROM (SELECT asset_id, code FROM sheet_codes) g
LEFT JOIN (SELECT asset_id, code, name FROM (SELECT asset_id, ('0x' || code_hex)::INT AS code, name,
  row_number() OVER (PARTITION BY asset_id, ('0x' || code_hex)::INT ORDER BY b DESC, k DESC) AS x FROM rules_out) WHERE x = 1) r
  ON r.asset_id = g.asset_id AND r.code = g.code""",
)
def glyph_names(spark, sf):
    sheets = view(spark, sf, "sheet_fx")
    wanted = _part_codes(spark, sf)
    return name_glyphs(wanted, styles.css_rules(sheets)).select("asset_id", "code", "icon_name")


part(
    "sheet_codes",
    """SELECT 'p' || p_partkey AS asset_id, unnest([58880 + 0, ('0xe' || (600 + p_size))::INT, ('0xe' || (600 + p_partkey % 9))::INT]) AS code FROM part""",
)


def _part_codes(spark, sf):
    return table(spark, sf, "part").selectExpr(
        "concat('p', cast(p_partkey AS string)) AS asset_id",
        "explode(array(58880, cast(conv(concat('e', cast(600 + p_size AS string)), 16, 10) AS int),"
        " cast(conv(concat('e', cast(600 + p_partkey % 9 AS string)), 16, 10) AS int))) AS code",
    )
