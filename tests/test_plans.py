"""Whole runs over the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import catalog
from catalog import fixtures as fx
from catalog.check import _rows
from glyphledger.operators import conflicts as cf
from glyphledger.operators.registry import build_registry, outlines
from glyphledger.operators.resolution import load_decisions
from glyphledger.operators.similarity import outlines_by_asset
from glyphledger.plans.corpus import build_from_glyphs, collect_links
from glyphledger.plans.curate import curate
from glyphledger.plans.publish import plan_rewrites, publish

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in fx.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert sum(q.sql is None for q in catalog.QUERIES.values()) <= 3


@pytest.mark.parametrize(
    "name", ["canonical_pick", "conflict_records", "glyph_normalisation", "static_icon_usage", "merged_items", "plan_dry_run"]
)
def test_query_equals_its_check(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.execute(entry.oracle_sql()[name])
    want = _rows(rel.fetchall(), [d[0] for d in rel.description])
    assert _rows(df.collect(), df.columns) == want


def test_curation_leaves_no_shared_codes(spark):
    glyphs = fx.glyphs(spark, SF)
    reg = build_registry(glyphs)

    def decide(found, step):
        return load_decisions(fx.raw_decisions(found.records, found.variants))

    lo, hi = 0xF0000, 0xFFFFD
    coded, final, log = curate(reg, decide, outlines(glyphs), lo, hi)
    assert cf.code_conflicts(coded.entries).count() == 0
    assert log.count() == log.select("new_code").distinct().count() > 0
    assert final.glyphs.count() == coded.entries.select("glyph_hash").distinct().count()
    tables = publish(final, outlines_by_asset(glyphs), fx.view(spark, SF, "asset_fx"))
    assert tables["glyphs"].count() > 0 and tables["css"].count() > 0
    files = fx.view(spark, SF, "repo_fx")
    plans = plan_rewrites(coded, final, files, fx.view(spark, SF, "asset_project_fx"))
    assert plans["diff"].count() > 0


def test_corpus(spark):
    files = fx.view(spark, SF, "repo_fx")
    seeds = spark.createDataFrame([("//seed.example/font_1_a.css",)], ["url"])
    from catalog.text_queries import PATTERNS

    page = "<script>u = '<%= htmlWebpackPlugin.options.path %>iconfont/font_5_t.css'</script>"
    made = spark.createDataFrame([("shop", "index.html", ".html", page), ("shop", "a.js", ".js", page[8:-9])], "project string, path string, ext string, content string")
    paths = spark.createDataFrame([("shop", "//static.example/", None)], "project string, public_path string, assets_path string")
    filled = collect_links(made, PATTERNS, seeds, paths).found.collect()
    assert {(r["path"], r["url"]) for r in filled} == {(p, "https://static.example/iconfont/font_5_t.css") for p in ("index.html", "a.js")}
    assert collect_links(made, PATTERNS, seeds).found.count() == 0
    tables = collect_links(files, PATTERNS, seeds)
    urls = {r["url"] for r in tables.index.collect()}
    assert "https://seed.example/font_1_a.css" in urls and len(urls) > 1
    raw = fx.contours(spark, SF).withColumns(
        {"code": F.col("vec_id").cast("int"), "ord": F.col("vec_id"), "num_contours": F.size("contours")}
    ).drop("units_per_em")
    rules = spark.createDataFrame([("v1", "1", "icon-one", 1)], "asset_id string, code_hex string, name string, ord int")
    units = spark.createDataFrame([("v5", 560)], "asset_id string, units_per_em int")
    reg = build_from_glyphs(raw, rules, units)
    total = raw.filter("glyph_type <> 'composite'").count()
    assert reg.sources.count() == total
    assert reg.aliases.first()["alias"] == "icon-one"
