import random

import pytest
from pyspark.sql import functions as F

from glyphledger.operators import conflicts as cf
from glyphledger.operators import registry as rg
from glyphledger.operators.ordering import number_rows, number_within

SCHEMA = (
    "glyph_hash string, asset_id string, code int, icon_name string, ord int,"
    " glyph_type string, num_contours int, advance_width double"
)


def glyphs(spark, rows):
    full = [(h, a, c, n, i, "empty" if h == "empty" else "simple", 1, 10.0 + i) for i, (h, a, c, n) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def entry(spark, rows):
    reg = rg.build_registry(glyphs(spark, rows))
    return {r["glyph_hash"]: r for r in reg.entries.collect()}, reg


def test_most_frequent_code_then_name_then_asset(spark):
    got, _ = entry(
        spark,
        [
            ("h", "a1", 10, "x"), ("h", "a2", 11, "y"), ("h", "a3", 11, "z"), ("h", "a3", 11, "z"),
            ("h", "a2", 11, "y"), ("h", "a4", 11, "z"),
        ],
    )
    assert (got["h"]["code"], got["h"]["name"], got["h"]["asset_id"]) == (11, "z", "a3")
    assert (got["h"]["alias_count"], got["h"]["source_count"], got["h"]["advance_width"]) == (3, 4, 10.0)


def test_first_met_wins_ties(spark):
    got, _ = entry(spark, [("h", "a2", 20, "b"), ("h", "a1", 10, "a"), ("h", "a1", 10, None), ("h", "a2", 20, None)])
    assert (got["h"]["code"], got["h"]["name"], got["h"]["asset_id"]) == (20, "b", "a2")


def test_missing_name_counts_as_blank(spark):
    got, reg = entry(spark, [("h", "a", 10, None), ("h", "b", 10, ""), ("h", "c", 10, "n")])
    assert got["h"]["name"] == ""
    assert [r["alias"] for r in reg.aliases.collect()] == ["n"]


def test_empty_group_has_sources_only(spark):
    got, reg = entry(spark, [("empty", "a", 10, "n"), ("empty", "b", 11, "m"), ("h", "a", 12, "n")])
    e = got["empty"]
    assert (e["code"], e["code_hex"], e["name"], e["asset_id"], e["glyph_type"], e["num_contours"]) == (
        None, None, None, None, "empty", 0,
    )
    assert (e["alias_count"], e["source_count"], e["advance_width"]) == (0, 2, None)
    assert rg.unicode_map(reg.entries).count() == 1


def test_source_keeps_first_code(spark):
    _, reg = entry(spark, [("h", "a", 12, "n"), ("h", "a", 10, "n"), ("h", "b", 10, "n")])
    assert {(r["asset_id"], r["original_code"]) for r in reg.sources.collect()} == {("a", 12), ("b", 10)}
    known = spark.createDataFrame([("a", "u")], ["asset_id", "css_url"])
    assert {(r["asset_id"], r["css_url"]) for r in rg.source_details(reg.sources, known).collect()} == {("a", "u"), ("b", None)}


def test_summary_buckets(spark):
    rows = [(f"h{n}", f"a{i}", 1, "n") for n in (1, 2, 5, 6, 10, 11) for i in range(n)]
    _, reg = entry(spark, rows)
    s = rg.registry_summary(reg.entries).first()
    assert (s["single_source"], s["two_to_five"], s["six_to_ten"], s["eleven_plus"]) == (1, 2, 2, 1)
    assert (s["max_sources_per_entry"], s["total_aliases"]) == (11, 6)


def test_alias_preview_tail(spark):
    _, reg = entry(spark, [("h", "a", 1, f"n{i}") for i in range(7)] + [("k", "a", 1, "z")])
    got = {r["glyph_hash"]: r["preview"] for r in rg.top_aliases(reg).collect()}
    assert got == {"h": "n0, n1, n2, n3, n4 ... (+2)", "k": "z"}


def test_result_does_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("pqrst"), rnd.choice("abcd"), rnd.randint(1, 3), rnd.choice(["x", "y", None])) for _ in range(300)]
    base = glyphs(spark, rows)
    want = sorted(map(str, rg.build_registry(base).entries.collect()))
    for n in (1, 7):
        assert sorted(map(str, rg.build_registry(base.repartition(n, "ord")).entries.collect())) == want


def entries(spark, rows):
    """(hash, code, name, sources) rows as registry entries."""
    return spark.createDataFrame(
        [(h, c, None if c is None else f"{c:04X}", n, s, c or 0, None) for h, c, n, s in rows],
        "glyph_hash string, code int, code_hex string, name string, source_count long, ord_major long, advance_width double",
    )


def test_conflict_kinds(spark):
    e = entries(
        spark,
        [("h1", 0xE001, "a", 1), ("h2", 0xE001, "b", 3), ("h3", 0xE002, "b", 5), ("h4", None, None, 2), ("h5", None, "", 1), ("h6", 0xE003, "", 1)],
    )
    got = {(r["type"], r["key"]): r for r in cf.all_conflicts(e).collect()}
    assert set(got) == {
        ("unicode_conflict", "U+E001"), ("name_conflict", "b"),
        ("glyph_duplicate", "h2"), ("glyph_duplicate", "h3"), ("glyph_duplicate", "h4"),
    }
    assert [got["glyph_duplicate", k]["severity"] for k in ("h2", "h3", "h4")] == ["warning", "critical", "info"]
    assert got["glyph_duplicate", "h3"]["variant_count"] == 1
    assert got["unicode_conflict", "U+E001"]["resolution_hint"] == "assign_pua"


def test_same_fingerprint_twice_is_no_conflict_but_a_collision(spark):
    e = entries(spark, [("h1", 1, "a", 1), ("h1", 1, "a", 1)])
    assert cf.code_conflicts(e).count() == 0 and cf.name_conflicts(e).count() == 0
    assert cf.entry_collisions(e, "name").first()["entries"] == 2


def test_records_are_numbered_by_severity_then_key(spark):
    e = entries(spark, [(f"h{i}", 0xE001, f"n{i}", 1) for i in range(5)] + [("k1", 0xE000, "m", 2), ("k2", 0xE000, "m", 1)])
    rows = cf.number_records(cf.all_conflicts(e)).orderBy("rid").collect()
    assert [(r["rid"], r["severity"], r["key"]) for r in rows] == [
        (0, "critical", "U+E001"), (1, "info", "U+E000"), (2, "info", "k1"), (3, "info", "m"),
    ]


def test_variants_follow_registry_order(spark):
    e = entries(spark, [("zz", 1, "n", 1), ("aa", 2, "n", 1), ("mm", 1, "x", 1)])
    records = cf.all_conflicts(e)
    got = cf.conflict_variants(e, records).orderBy("group_id", "pos").collect()
    assert [(r["group_id"], r["pos"], r["glyph_hash"]) for r in got] == [
        ("c1", 0, "mm"), ("c1", 1, "zz"), ("nn", 0, "zz"), ("nn", 1, "aa"),
    ]


def test_matrix_has_totals(spark):
    e = entries(spark, [("h1", 1, "a", 2), ("h2", 1, "b", 6)])
    got = {(r["type"], r["severity"]): r["records"] for r in cf.conflict_matrix(cf.all_conflicts(e)).collect()}
    assert got["all", "all"] == 3 and got["glyph_duplicate", "all"] == 2 and got["all", "info"] == 2


def test_residual_marks_known_keys(spark):
    e = entries(spark, [("h1", 1, "a", 1), ("h2", 1, "b", 1), ("h3", 2, "c", 1), ("h4", 2, "d", 1)])
    r = cf.all_conflicts(e)
    got = {x["key"]: x["in_review"] for x in cf.residual(r, r.filter("key = 'U+0001'")).collect()}
    assert got == {"U+0001": True, "U+0002": False}


@pytest.mark.parametrize("parts", [1, 9])
def test_positions_equal_plain_ranking(spark, parts):
    rnd = random.Random(parts)
    rows = list({(rnd.choice("ab" * 1 + "a" * 8), f"{rnd.getrandbits(40):010x}") for _ in range(500)})
    df = spark.createDataFrame(rows, ["k", "h"]).repartition(parts)
    got = {(r["k"], r["h"]): r["at"] for r in number_within(df, ["k"], ["h"], "at").collect()}
    for key in "ab":
        for at, h in enumerate(sorted(h for k, h in rows if k == key)):
            assert got[key, h] == at
    numbered = number_rows(df, ["h", "k"], "at").collect()
    assert [(r["h"], r["k"]) for r in sorted(numbered, key=lambda r: r["at"])] == sorted((h, k) for k, h in rows)
    assert sorted(r["at"] for r in numbered) == list(range(len(rows)))


def test_name_listing_puts_blanks_last(spark):
    e = entries(spark, [("h1", None, None, 1), ("h2", 0xE002, "b", 1), ("h3", 0xE001, "a", 1), ("h4", 0x41, "c", 1)])
    assert [r["glyph_hash"] for r in rg.name_listing(e).collect()] == ["h4", "h3", "h2", "h1"]
    assert rg.private_code_count(e).first()["private_codes"] == 2


def test_positions_in_a_hot_key_over_many_partitions(spark):
    """One key holds most rows and fills several partitions; positions go on across them."""
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), (F.col("id") % 300).cast("string"))).otherwise("hot").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("h"),
    )
    placed = number_within(df, ["k"], ["h"], "at")
    rows = {}
    for r in placed.collect():
        rows.setdefault(r["k"], []).append((r["h"], r["at"]))
    assert sum(map(len, rows.values())) == 20_000
    for found in rows.values():
        assert [at for _, at in sorted(found)] == list(range(len(found)))
    # No window runs over the rows of a key: its input is one row a key and partition.
    assert number_within(df.limit(0), ["k"], ["h"], "at").count() == 0


def test_numbering_moves_no_text_and_counts_joined_rows_only(spark, tmp_path):
    from catalog.fixtures import ORD, World

    src = "/root/testdata/sf0.001"
    for t in ("part", "supplier", "nation"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    items = spark.read.parquet(f"{src}/lineitem.parquet")
    lost = items.limit(7).withColumn("l_partkey", F.lit(-1).cast("long")).union(items.limit(5).withColumn("l_suppkey", F.lit(None).cast("long")))
    items.union(lost).write.parquet(f"{tmp_path}/lineitem.parquet")
    w = World(spark, str(tmp_path))
    n = items.count()
    r = w.numbered.agg(F.count("ord"), F.countDistinct("ord"), F.min("ord"), F.max("ord")).first()
    assert tuple(r) == (n, n, 0, n - 1)
    stages = {f.rsplit("/", 1)[0] for f in w.numbered.inputFiles() if "/stage-" in f}
    assert len(stages) == 1
    assert set(spark.read.parquet(*stages).columns) == {*ORD.split(", "), "_p", "_m"}
