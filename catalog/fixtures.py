"""Inputs of the queries, derived from the given tables.

One SQL text per view serves both engines; only the digest function is named
differently. Everything runs over whole tables.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphledger.operators.conflicts import (
    DUPLICATE,
    all_conflicts,
    conflict_variants,
    number_records,
)
from glyphledger.operators.ordering import number_rows
from glyphledger.operators.registry import Registry, build_registry
from glyphledger.operators.resolution import load_decisions
from glyphledger.session import materialize

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

ORD = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
ICON = "concat('icon-', replace(p_name, ' ', '_'), '_', cast(p_partkey % 5 AS string))"

# Views over the tables. {sha:...}, {ord} and {settings} differ between the engines.
VIEWS: dict[str, str] = {
    "glyph_fx": f"""
SELECT concat('a', cast(l_suppkey AS string)) AS asset_id,
       n_name AS project,
       cast(58880 + p_size*10 + p_partkey % 7 AS int) AS code,
       CASE WHEN p_partkey % 50 <> 0 THEN {ICON} END AS icon_name,
       CASE WHEN p_partkey % 200 = 199 THEN 'empty' ELSE 'simple' END AS glyph_type,
       CASE WHEN p_partkey % 200 = 199 THEN 'empty'
            WHEN p_partkey % 4 = 0 THEN substr({{sha:concat(p_brand,'|',p_type)}},1,16)
            ELSE substr({{sha:concat('p',cast(p_partkey AS string))}},1,16) END AS glyph_hash,
       cast(CASE WHEN p_partkey % 200 = 199 THEN 0 ELSE 1 + p_partkey % 3 END AS int) AS num_contours,
       cast(p_size*20 AS double) AS advance_width,
       p_partkey % 97 <> 3 AND p_partkey % 200 <> 199 AS has_outline,
       p_partkey AS part, {{ord}}
FROM lineitem JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "asset_fx": """
SELECT concat('a', cast(s_suppkey AS string)) AS asset_id,
       concat('https://cdn.example/a', cast(s_suppkey AS string), '.css') AS css_url,
       CASE WHEN s_suppkey % 10 <> 9 THEN concat('assets/a', cast(s_suppkey AS string), '/font.ttf') END AS ttf_path,
       CASE WHEN s_suppkey % 10 = 9 THEN 'css_404' ELSE 'ok' END AS download_status,
       CASE WHEN s_suppkey % 17 = 5 THEN 'cannot open' END AS error,
       CASE WHEN s_suppkey % 6 = 0 THEN 512 WHEN s_suppkey % 6 = 1 THEN 560 ELSE 1024 END AS units_per_em
FROM supplier""",
    "asset_project_fx": """
SELECT concat('a', cast(s_suppkey AS string)) AS asset_id, n_name AS project
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION
SELECT concat('a', cast(s_suppkey AS string)) AS asset_id, r_name AS project
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "sheet_fx": f"""
SELECT concat('p', cast(p_partkey AS string)) AS asset_id,
       concat('https://cdn.example/a/b', cast(p_partkey % 10 AS string), '/iconfont.css') AS css_url,
       CASE WHEN p_partkey % 41 = 0 THEN 'css_404' ELSE 'ok' END AS download_status,
       CASE WHEN p_partkey % 41 <> 0 AND p_partkey % 43 <> 0 THEN concat(
         CASE p_partkey % 6
           WHEN 0 THEN '@font-face{{{{src:url("../fonts/f.woff2?t=1"),url("../fonts/f.ttf?t=1")}}}}'
           WHEN 1 THEN '@font-face{{{{src: url( //cdn.example/f.woff2 )}}}}'
           WHEN 2 THEN '@font-face{{{{src:URL("/abs/f.WOFF")}}}}'
           WHEN 3 THEN '@font-face{{{{src:url(https://x.example/f.ttf)}}}}'
           WHEN 4 THEN '.base{{{{color:red}}}}'
           ELSE '@font-face{{{{src:url(f1.woff),url("./x/../f2.woff2?v=2")}}}}' END,
         chr(10), '.', {ICON}, ':before, .s-', cast(p_size AS string), ':after ,.plain{{{{content:"', chr(92), 'E', cast(600 + p_size AS string), '"',
         CASE WHEN p_partkey % 2 = 0 THEN ';' ELSE '' END, '}}}}', chr(10),
         CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('.icon', substr(p_brand,1,1), 'x{{{{color:#fff;content:', chr(92), 'e', cast(600 + p_partkey % 9 AS string), ' ;}}}}') END,
         '.icon-x y{{{{content:"', chr(92), 'e1"}}}} .icon-last{{{{content:''', chr(92), 'E', cast(600 + p_size AS string), ''' }}}}')
       END AS css
FROM part""".replace("{{", "{").replace("}}", "}"),
    "repo_fx": f"""
SELECT n_name AS project,
       concat(CASE p_partkey % 5 WHEN 4 THEN 'node_modules/m/p' ELSE 'src/p' END, cast(p_partkey AS string),
              CASE p_partkey % 4 WHEN 0 THEN '.vue' WHEN 1 THEN '.js' WHEN 2 THEN '.CSS' ELSE '.html' END) AS path,
       CASE p_partkey % 4 WHEN 0 THEN '.vue' WHEN 1 THEN '.js' WHEN 2 THEN '.css' ELSE '.html' END AS ext,
       concat(
         CASE WHEN p_partkey % 3 = 0 THEN concat('<link rel="stylesheet" href="//cdn.example/iconfont/font_', cast(p_partkey % 20 AS string), '_ab.css"><link rel="stylesheet" href="/x.css">')
              ELSE concat('@import "//static.example/iconfont/font_', cast(p_partkey % 20 AS string), '_ab.css";') END, chr(10),
         '<i class="icon ', {ICON}, ' icon-extra ', {ICON}, '"></i>', chr(10),
         '  const n = ''', {ICON}, '_x'' + x; // see //cdn.example/iconfont/font_99_zz.css', chr(10),
         '/* @import "//static.example/iconfont/font_77_old.css"; ', chr(10), ' */ <b :class="ok icon-', lower(p_type), '-2">', chr(10),
         '<!-- <link href="//cdn.example/iconfont/font_88_no.css"> -->', chr(10),
         '<SCRIPT lang="ts">/* a */ var u = "http://cdn.example/t/font_5_q.js"; // gone', chr(10), 'f()</SCRIPT>', chr(10),
         '<style>/* b */ p{{{{margin:0}}}}</style>', chr(10),
         'tail //cdn.example/t/c/font_', cast(p_partkey % 30 AS string), '_k9.css and icon-none-'
       ) AS content,
       p_partkey AS ord
FROM part JOIN nation ON p_partkey % 25 = n_nationkey""".replace("{{", "{").replace("}}", "}"),
    "setting_fx": """
SELECT concat('cust', cast(c_custkey AS string)) AS project, path,
  CASE path
    WHEN 'package.json' THEN concat('{"name": "pkg', cast(c_custkey AS string), '", "version": "1"}')
    WHEN 'vue.config.js' THEN
      CASE c_custkey % 5
        WHEN 0 THEN 'module.exports = { publicPath: "/lit/", x: 1 }'
        WHEN 1 THEN concat('const base = ''//cdn.example/$', '{pkg.name}/''', chr(10), 'module.exports = { publicPath: base }')
        WHEN 2 THEN concat('const assetsPublicPath_pro = "//cdn.example/$', '{pkg.name}/pro"')
        WHEN 3 THEN concat('module.exports = { publicPath: missing }; assetsPublicPath_pro = `//cdn.example/q`')
        ELSE 'module.exports = {}' END
    WHEN 'config/index.js' THEN
      CASE WHEN c_custkey % 2 = 0 THEN concat('assetsPublicPath: ''//static.example/$', '{pkg.name}/''') ELSE 'x' END
    WHEN 'index.html' THEN
      concat('<link href="<%= htmlWebpackPlugin.options.path %>iconfont/font_1_a.css"><link href="<%=htmlWebpackPlugin.options.assetsPublicPath%>iconfont/font_2_b.css">',
        CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat(chr(10), '<style>@import', chr(10), '  url( <%= htmlWebpackPlugin.options.assetsPublicPath %>iconfont/broken.css', chr(10), ') ;</style>')
        ELSE concat(chr(10), 'x @import', chr(10), '"//o.example/iconfont/two.css"', chr(10), '; <%= htmlWebpackPlugin.options.path %> @import', chr(10), chr(10), '''<%=htmlWebpackPlugin.options.assetsPublicPath%>iconfont/three.css''; y @import', chr(10), 'z') END)
    WHEN 'src/app.js' THEN concat('import "../dist/iconfont.css"; import ''./a/./iconfont-', c_mktsegment, '.css''; import "//x/iconfont.css"')
    WHEN 'dist/iconfont.css' THEN concat('@font-face{src:url( "//static.example/font_', cast(c_custkey % 50 AS string), '_ab.ttf" ), url(a.png), url(https://o.example/IconFont.eot)} @import url("//static.example/iconfont/x.css");')
    ELSE concat('@import ''//static.example/iconfont/', lower(c_mktsegment), '.css''; @import "./local/iconfont.css"; @import url(https://o.example/font_3_c.css?iconfont=1) ; ')
  END AS content
FROM {settings}""",
    "page_file_fx": """
SELECT split_part(split_part(url, '://', 2), '/', 1) AS project,
       concat(cast(page_id AS string), '.html') AS path, '.html' AS ext, html AS content, page_id AS ord, url
FROM pages""",
    "doc_file_fx": """
SELECT source AS project, concat(cast(doc_id AS string), '.txt') AS path, '.txt' AS ext, text AS content, doc_id AS ord
FROM documents""",
    "link_fx": """
SELECT split_part(split_part(url, '://', 2), '/', 1) AS project,
  concat('https://', CASE page_id % 3 WHEN 0 THEN 'cdn.example' ELSE 'static.example/long/way' END, '/',
    CASE page_id % 5
      WHEN 0 THEN concat('t/font_', cast(page_id % 40 AS string), '_ab.css')
      WHEN 1 THEN concat('iconfont/14839337273', cast(10 + page_id % 20 AS string), '/css/symbols.css')
      WHEN 2 THEN concat('x/f', cast(page_id % 15 AS string), '.js')
      WHEN 3 THEN concat('x/f', cast(page_id % 15 AS string), '.ttf')
      ELSE concat('y/iconfont', cast(page_id % 12 AS string), '.CSS?v=', cast(page_id % 3 AS string)) END) AS url,
  page_id AS ord
FROM pages""",
    "path_fx": """
SELECT concat('cust', cast(o_custkey AS string)) AS project,
  concat(CASE o_orderkey % 4 WHEN 0 THEN 'src/' WHEN 1 THEN 'lib/dist/' WHEN 2 THEN 'node_modules/m/' ELSE '' END,
    CASE o_orderkey % 7 WHEN 0 THEN concat('f', cast(o_orderkey AS string), '.vue') WHEN 1 THEN '.env.local'
      WHEN 2 THEN concat('R', cast(o_orderkey AS string), '.HTML') WHEN 3 THEN 'README.md'
      WHEN 4 THEN 'vite.config.js' WHEN 5 THEN concat('x', cast(o_orderkey AS string), '.tar.gz') ELSE 'dist' END) AS path
FROM orders""",
    "binary_fx": """
SELECT concat('o', cast(o_orderkey AS string)) AS asset_id,
  o_orderkey * 37 % 5000 AS size,
  CASE o_orderkey % 6 WHEN 0 THEN '00010000' WHEN 1 THEN '74727565' WHEN 2 THEN '4F54544F'
    WHEN 3 THEN '774F4646' WHEN 4 THEN '774F4632' ELSE '3C68746D' END AS header,
  CASE WHEN o_orderkey % 23 <> 0 THEN concat('css/', cast(o_orderkey AS string)) END AS css_path,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey * 3 END AS css_size,
  CASE WHEN o_orderkey % 11 <> 0 THEN concat('ttf/', cast(o_orderkey AS string)) END AS ttf_path,
  CASE WHEN o_orderkey % 13 = 0 THEN 'css_404' ELSE 'ok' END AS download_status,
  o_orderkey % 19 <> 0 AS font_exists,
  o_orderkey * 7 % 90 AS mapping_count
FROM orders""",
    "export_fx": """
SELECT o_orderkey AS file_ord,
  concat('[{"type":"Project","project":{"name":"n', cast(o_orderkey AS string), '","web_url":"https://git.example/g', cast(o_custkey % 9 AS string), '/r', cast(o_custkey AS string), '"}},',
    '{"type":"Group","project":{"name":"z","web_url":"https://git.example/z"}},',
    '{"type":"Project","project":{"name":', CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE '"m"' END, ',"web_url":', CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE concat('"https://git.example/m', cast(o_orderkey % 300 AS string), '"') END, '}}]') AS body
FROM orders""",
}

SETTING_PATHS = ", ".join(
    f"'{p}'"
    for p in (
        "package.json", "vue.config.js", "config/index.js", "index.html",
        "src/app.js", "dist/iconfont.css", "src/main.css",
    )
)

ENGINE = {
    "spark": {
        "sha": "sha2(%s,256)",
        "ord": f"struct({ORD}) AS ord",
        "settings": f"(SELECT *, explode(array({SETTING_PATHS})) AS path FROM customer)",
    },
    "duckdb": {
        "sha": "sha256(%s)",
        "ord": f"row_number() OVER (ORDER BY {ORD}) AS rn",
        "settings": f"(SELECT *, unnest([{SETTING_PATHS}]) AS path FROM customer)",
    },
}


def view_sql(name: str, engine: str, ord: str | None = None) -> str:
    text = VIEWS[name]
    for token in ("ord", "settings"):
        text = text.replace("{" + token + "}", ord if ord and token == "ord" else ENGINE[engine][token])
    while "{sha:" in text:
        start = text.index("{sha:")
        end = text.index("}", start)
        text = text[:start] + ENGINE[engine]["sha"] % text[start + 5 : end] + text[end + 1 :]
    return text


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str, ord: str | None = None, **tables: DataFrame) -> DataFrame:
    """A view over the tables of one folder; the plan is bound before the names are reused.

    ``tables`` stand for tables of the folder, ``ord`` for the order column of their rows.
    """
    sql = view_sql(name, "spark", ord)
    for t in TABLES:
        if re.search(rf"\b{t}\b", sql):
            tables.get(t, table(spark, sf, t)).createOrReplaceTempView(t)
    return spark.sql(sql)


def glyphs(spark: SparkSession, sf: str) -> DataFrame:
    """Glyph rows, numbered once in table order, with a small outline per part."""
    box = F.array(
        *[
            F.struct(
                (F.lit(dx) * (F.col("part") % 9 + 1)).cast("double").alias("x"),
                F.lit(float(dy)).alias("y"),
                F.lit(True).alias("on_curve"),
            )
            for dx, dy in ((0, 0), (10, 0), (10, 10))
        ]
    )
    return world(spark, sf).numbered.withColumn(
        "contours", F.when(F.col("has_outline"), F.array(box))
    )


def contours(spark: SparkSession, sf: str) -> DataFrame:
    """Four contours of eight points per embedding."""
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id",
        "label",
        "concat('v', cast(vec_id AS string)) AS asset_id",
        "CASE WHEN vec_id % 5 = 0 THEN 560 ELSE 1024 END AS units_per_em",
        "CASE WHEN vec_id % 50 = 7 THEN 'empty' WHEN vec_id % 50 = 8 THEN 'composite' ELSE 'simple' END AS glyph_type",
        "cast(vec_id % 700 AS double) + 0.00005 AS advance_width",
        "cast(vec_id % 13 AS double) AS lsb",
        """transform(sequence(0,3), k -> transform(sequence(0,7), i -> named_struct(
             'x', cast(embedding[k*16+2*i] AS double)*1000,
             'y', cast(embedding[k*16+2*i+1] AS double)*1000,
             'on_curve', i % 3 <> 2))) AS contours""",
    )


def variants_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Outlines that differ by little, by some, or by much, depending on the label."""
    return table(spark, sf, "embeddings").selectExpr(
        "concat('g', cast(label AS string), '-', cast(vec_id % 4 AS string)) AS group_id",
        "lpad(cast(vec_id AS string), 12, '0') AS variant_id",
        """transform(sequence(0, CASE WHEN label = 9 AND vec_id % 11 = 0 THEN 2 ELSE 3 END),
             k -> transform(sequence(0,7), i -> named_struct(
             'x', 200.0*k + CASE WHEN i IN (1,2,3,4) THEN 150.0 ELSE 0.0 END
                  + cast(embedding[k*16+2*i] AS double)*CASE label % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 6.0 WHEN 2 THEN 30.0 ELSE 400.0 END,
             'y', CASE WHEN i IN (3,4,5,6) THEN 700.0 ELSE 0.0 END
                  + cast(embedding[k*16+2*i+1] AS double)*CASE label % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 6.0 WHEN 2 THEN 30.0 ELSE 400.0 END,
             'on_curve', i % 3 <> 2))) AS contours""",
    )


@dataclass
class World:
    """Stage tables shared by later queries; each is written once per application and folder."""

    spark: SparkSession
    sf: str

    def view(self, name: str) -> DataFrame:
        return view(self.spark, self.sf, name)

    @cached_property
    def numbered(self) -> DataFrame:
        """Glyph rows with ``ord`` as one number, as a loader gives it.

        The narrow order columns of the rows that have a part and a supplier are numbered
        alone; the view is then formed over the numbered rows, so its wide text is never
        moved, sampled or written for the numbering.
        """
        items, parts, makers, nations = (table(self.spark, self.sf, t) for t in ("lineitem", "part", "supplier", "nation"))
        made = makers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
        keys = (
            items.select(*ORD.split(", "))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
            .join(made, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
        )
        return view(self.spark, self.sf, "glyph_fx", lineitem=number_rows(keys, ORD.split(", "), "ord"), ord="ord")

    @cached_property
    def glyphs(self) -> DataFrame:
        return glyphs(self.spark, self.sf)

    @cached_property
    def reg(self) -> Registry:
        r = build_registry(self.glyphs)
        return Registry(materialize(r.entries), materialize(r.aliases), materialize(r.sources))

    @cached_property
    def records(self) -> DataFrame:
        """Numbered conflicts; every seventh code or name record counts as a false positive."""
        fp = (F.col("type") != DUPLICATE) & (F.col("rid") % 7 == 0)
        numbered = number_records(all_conflicts(self.reg.entries))
        return materialize(numbered.withColumn("is_false_positive", fp))

    @cached_property
    def variants(self) -> DataFrame:
        return materialize(conflict_variants(self.reg.entries, self.records))

    @cached_property
    def decisions(self) -> DataFrame:
        return load_decisions(raw_decisions(self.records, self.variants))

    @cached_property
    def asset_projects(self) -> DataFrame:
        return self.view("asset_project_fx")

    @cached_property
    def assets(self) -> DataFrame:
        return self.view("asset_fx")


_WORLDS: dict[tuple[str, str], World] = {}


def world(spark: SparkSession, sf: str) -> World:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WORLDS:
        _WORLDS[key] = World(spark, sf)
    return _WORLDS[key]


def raw_decisions(records: DataFrame, variants: DataFrame) -> DataFrame:
    """Decisions by record id: groups, a kept whole, a partly grouped record, the older form, none."""
    heads = records.filter(F.col("type") != DUPLICATE).select("group_id", "rid", "variant_count")
    v = variants.select("group_id", "pos").join(heads, "group_id")
    m, pos = F.col("rid") % 5, F.col("pos")
    none = F.lit(None)
    group_no = (
        F.when(m == 1, F.when(pos == 0, 0).otherwise(1 + (pos + 1) % 2))
        .when(m == 2, 0)
        .when((m == 3) & (pos == 0), 0)
    )
    rows = v.select(
        "rid",
        (F.col("rid") % 14 == 0).alias("unmerge"),
        group_no.cast("int").alias("group_no"),
        F.when(group_no == 0, "keep").when(group_no > 0, "pua").alias("group_type"),
        F.when(F.col("rid") % 10 == 7, F.col("variant_count") - 1 - pos).otherwise(pos).cast("int").alias("list_pos"),
        F.when(group_no.isNotNull(), pos).alias("pos"),
        F.when((m == 4) & (pos == 0), "keep").when((m == 4) & (pos == 1), "pua").alias("action"),
        F.when((m == 4) & (pos < 2), pos).alias("variant_index"),
    ).filter(F.col("group_no").isNotNull() | F.col("action").isNotNull())
    only_unmerge = heads.filter((m == 0) & (F.col("rid") % 14 == 0)).select(
        "rid",
        F.lit(True).alias("unmerge"),
        none.cast("int").alias("group_no"),
        none.cast("string").alias("group_type"),
        none.cast("int").alias("list_pos"),
        none.cast("long").alias("pos"),
        none.cast("string").alias("action"),
        none.cast("long").alias("variant_index"),
    )
    return rows.unionByName(only_unmerge)
