import pytest
from pyspark.sql import functions as F

from glyphledger.operators import allocation as al
from glyphledger.operators import conflicts as cf
from glyphledger.operators import registry as rg
from glyphledger.operators import resolution as rs
from glyphledger.operators import rewrites as rw
from tests.test_registry import glyphs

RAW = (
    "rid long, unmerge boolean, group_no int, group_type string, list_pos int, pos long, action string, variant_index long"
)


def asks(spark, n):
    return spark.createDataFrame([(f"h{i}", n - i) for i in range(n)], "glyph_hash string, place int")


def codes(df):
    return {r["glyph_hash"]: r["new_code"] for r in df.collect()}


def test_allocates_in_order_and_skips_used(spark):
    used = spark.createDataFrame([(11,), (13,), (500,), (None,)], "code int")
    assert codes(al.allocate(asks(spark, 3), ["place"], used, 10, 20)) == {"h2": 10, "h1": 12, "h0": 14}
    assert codes(al.allocate(asks(spark, 3), ["place"], None, 10, 20)) == {"h2": 10, "h1": 11, "h0": 12}


def test_full_range_is_enough_and_one_more_fails(spark):
    assert len(codes(al.allocate(asks(spark, 5), ["place"], None, 10, 14))) == 5
    with pytest.raises(Exception, match="code range exhausted"):
        al.allocate(asks(spark, 6), ["place"], None, 10, 14).collect()
    used = spark.createDataFrame([(12,)], "code int")
    with pytest.raises(Exception, match="code range exhausted"):
        al.allocate(asks(spark, 5), ["place"], used, 10, 14).collect()


@pytest.mark.parametrize("used", [False, True])
def test_too_many_requests_fail_whatever_is_read(spark, used):
    taken = spark.createDataFrame([(12,)], "code int") if used else None
    with pytest.raises(ValueError, match="code range exhausted"):
        al.allocate(asks(spark, 50), ["place"], taken, 10, 14).count()
    with pytest.raises(ValueError, match="code range exhausted"):
        al.allocate(asks(spark, 50), ["place"], taken, 10, 14).select("glyph_hash").collect()


class Case:
    """Four fingerprints on one code, two of them under one name, and a lone one."""

    def __init__(self, spark, decisions=(), false_positive=()):
        rows = [
            ("h1", "a1", 0xE601, "x"), ("h1", "a2", 0xE601, "x"), ("h1", "a3", 0xE602, "xx"),
            ("h2", "a1", 0xE601, "y"), ("h3", "a4", 0xE601, "z"), ("h3", "a5", 0xE601, "z"), ("h3", "a6", 0xE601, "z"),
            ("h4", "a7", 0xE601, "y"), ("h9", "a9", 0xE777, "solo"),
        ]
        self.reg = rg.build_registry(glyphs(spark, rows))
        numbered = cf.number_records(cf.all_conflicts(self.reg.entries))
        self.ids = {r["key"]: r["rid"] for r in numbered.collect()}
        self.records = numbered.withColumn("is_false_positive", F.col("key").isin(*false_positive, ""))
        self.variants = cf.conflict_variants(self.reg.entries, self.records)
        raw = [(self.ids[key], *rest) for key, *rest in decisions]
        self.decisions = rs.load_decisions(spark.createDataFrame(raw, RAW))

    def resolved(self, lo=0xE000, hi=0xE0FF):
        res = rs.resolve(self.reg, self.records, self.variants, self.decisions, lo, hi)
        return res, {r["glyph_hash"]: r for r in res.glyphs.collect()}


def grp(key, no, kind, *pos, unmerge=None):
    return [(key, unmerge, no, kind, i, p, None, None) for i, p in enumerate(pos)]


def test_sources_of_all_items_are_grouped_once(spark):
    case = Case(spark, grp("U+E601", 0, "keep", 0, 1) + grp("U+E601", 1, "pua", 2, 3))
    res, _ = case.resolved()
    assert {r["asset_id"] for r in res.sources.filter("glyph_hash = 'h1'").collect()} == {"a1", "a2", "a3"}
    assert {r["asset_id"] for r in res.sources.filter("glyph_hash = 'h3'").collect()} == {"a4", "a5", "a6", "a7"}
    grouped = res.sources._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Aggregate [" in line and "asset_id" in line for line in grouped.split("\n")) == 3  # twice the registry's own, and this one


def test_undecided_variants_all_get_new_codes(spark):
    case = Case(spark)
    _, got = case.resolved()
    # One code conflict (h1 h2 h3 h4), one name conflict (h2 h4); the code conflict comes first.
    assert [(got[h]["final_code"], got[h]["final_name"]) for h in ("h1", "h2", "h3", "h4")] == [
        (0xE000, "x_v1"), (0xE001, "y_v2"), (0xE002, "z_v3"), (0xE003, "y_v4"),
    ]
    assert got["h1"]["resolution"] == "pua_assigned"
    assert (got["h9"]["resolution"], got["h9"]["final_name"]) == ("single_source", "solo")
    members = rs.item_members(case.records.filter("type <> 'glyph_duplicate'"), case.variants, case.decisions)
    items = rs.resolve_items(members, case.reg.sources)
    stats = {r["type"]: r for r in rs.resolution_stats(items, case.records.filter("type <> 'glyph_duplicate'"), case.decisions).collect()}
    a = stats["unicode_conflict"]
    assert (a["assigned"], a["auto_resolved"], a["settled"]) == (4, 4, 8)


def test_per_variant_decisions_in_the_older_form(spark):
    case = Case(spark, [("U+E601", None, None, None, None, None, "keep", 2), ("U+E601", None, None, None, None, None, "pua", 0)])
    res, got = case.resolved()
    assert (got["h3"]["final_code"], got["h3"]["final_name"], got["h3"]["resolution"]) == (0xE601, "z", "kept_original")
    assert (got["h1"]["final_code"], got["h1"]["final_name"]) == (0xE000, "x_v1")
    assert {r["alias"] for r in res.aliases.filter("glyph_hash = 'h1'").collect()} == {"x"}
    assert res.aliases.filter("glyph_hash = 'h3'").count() == 0


def test_groups_merge_and_number_only_known_groups(spark):
    case = Case(spark, grp("U+E601", 0, "pua", 99) + grp("U+E601", 1, "keep", 2, 0) + grp("U+E601", 2, "pua", 1, 3))
    res, got = case.resolved()
    assert (got["h3"]["final_code"], got["h3"]["final_name"], got["h3"]["resolution"]) == (0xE601, "z", "group_kept")
    assert got["h3"]["merged_variant_count"] == 2
    assert {r["asset_id"] for r in res.sources.filter("glyph_hash = 'h3'").collect()} == {"a1", "a2", "a3", "a4", "a5", "a6"}
    assert {r["alias"] for r in res.aliases.filter("glyph_hash = 'h3'").collect()} == {"x", "z"}
    assert (got["h2"]["final_code"], got["h2"]["final_name"]) == (0xE000, "y_g2")
    # h1 was merged away as the second of its group, but every registry entry stays in the result.
    assert got["h1"]["resolution"] == "alias_merged"


def test_false_positive_merges_whole_unless_unmerged(spark):
    _, got = Case(spark, false_positive=["U+E601"]).resolved()
    assert (got["h1"]["final_code"], got["h1"]["final_name"], got["h1"]["resolution"]) == (0xE601, "x", "false_positive_merged")
    assert got["h1"]["merged_variant_count"] == 4
    split = Case(spark, [("U+E601", True, None, None, None, None, None, None)], false_positive=["U+E601"])
    assert split.resolved()[1]["h1"]["resolution"] == "pua_assigned"


def test_alias_map_last_writer_wins(spark):
    case = Case(spark)
    res, _ = case.resolved()
    got = {r["name"]: r["glyph_hash"] for r in rs.alias_map(res).collect()}
    # h2 and h4 both claim the old name; h4 stands later.
    assert got["y"] == "h4" and got["x_v1"] == "h1" and got["solo"] == "h9"


def test_name_resolution_replaces_entries(spark):
    keep = Case(spark, grp("y", 0, "keep", 0) + grp("y", 1, "pua", 1))
    new = rw.apply_name_resolution(keep.reg, keep.records, keep.variants, keep.decisions, 0xE000, 0xE0FF)
    got = {r["glyph_hash"]: r for r in new.entries.collect()}
    assert set(got) == {"h1", "h2", "h3", "h4", "h9"}
    assert (got["h2"]["name"], got["h2"]["code"]) == ("y", 0xE601)
    assert (got["h4"]["name"], got["h4"]["code"], got["h4"]["code_hex"]) == ("y_v2", 0xE000, "E000")
    merged = Case(spark, false_positive=["y"])
    new = rw.apply_name_resolution(merged.reg, merged.records, merged.variants, merged.decisions)
    got = {r["glyph_hash"]: r for r in new.entries.collect()}
    assert set(got) == {"h1", "h2", "h3", "h9"} and got["h2"]["source_count"] == 2
    assert cf.name_conflicts(new.entries).count() == 0
    stats = rw.name_resolution_stats(merged.records, merged.variants, merged.decisions).first()
    assert (stats["fp_merged"], stats["decision_merged"], stats["skipped"]) == (1, 0, 0)


def run_passes(case):
    e, lo, hi = case.reg.entries, 0xE000, 0xE0FF
    user = rw.apply_code_user(e, case.records, case.variants, case.decisions, lo, hi)
    after = rw.with_changes(e, user)
    used = e.select("code").union(user.select("new_code"))
    auto = rw.apply_code_auto(after, case.records, case.variants, case.decisions, used, lo, hi)
    return codes(user), codes(auto), rw.with_changes(after, auto)


@pytest.mark.parametrize(
    "decisions, user, auto",
    [
        ([], {}, {"h1": 0xE000, "h2": 0xE001, "h4": 0xE002}),  # undecided: h3 has the most sources (tie: first)
        (grp("U+E601", 0, "keep", 1) + grp("U+E601", 1, "pua", 0, 2, 3), {"h1": 0xE000, "h3": 0xE001, "h4": 0xE002}, {}),
        (grp("U+E601", 0, "keep", 0, 1, 2, 3), {}, {"h2": 0xE000, "h3": 0xE001, "h4": 0xE002}),
        (grp("U+E601", 0, "keep", 1, 0), {}, {"h1": 0xE000, "h3": 0xE001, "h4": 0xE002}),
        (grp("U+E601", 0, "pua", 3), {"h4": 0xE000}, {"h2": 0xE001, "h3": 0xE002}),
    ],
)
def test_code_passes(spark, decisions, user, auto):
    case = Case(spark, decisions)
    got_user, got_auto, final = run_passes(case)
    if not decisions:
        auto = {"h2": 0xE000, "h3": 0xE001, "h4": 0xE002}  # h1 and h3 have three sources; h1 is first
    assert (got_user, got_auto) == (user, auto)
    assert cf.code_conflicts(final).count() == 0


def test_fallback_keeps_first_of_each_code(spark):
    case = Case(spark)
    updated = spark.createDataFrame([("h3",)], ["glyph_hash"])
    got = rw.apply_code_fallback(case.reg.entries, case.records, case.variants, updated, case.reg.entries.select("code"), 0xE000, 0xE0FF)
    assert codes(got) == {"h2": 0xE000, "h4": 0xE001}
    log = rw.lineage_log(got).orderBy("new_code").first()
    assert (log["action"], log["old_hex"], log["new_hex"], log["reason"]) == (
        "assign_pua", "E601", "E000", "Type A fallback resolution for U+E601",
    )


def test_name_first_effect(spark):
    case = Case(spark, false_positive=["y"])
    got = rw.name_first_effect(case.records, case.variants).first()
    assert (got["key"], got["hashes_left"], got["outcome"]) == ("U+E601", 3, "modified")
    queue = rw.review_queue(case.records, rw.name_first_effect(case.records, case.variants))
    assert {r["key"] for r in queue.filter("type <> 'glyph_duplicate'").collect()} == {"U+E601"}


def test_review_table_lists_first_projects(spark):
    case = Case(spark)
    projects = spark.createDataFrame(
        [(f"a{i}", f"p{i}") for i in range(1, 10)] + [("a1", "q"), ("a2", "q"), ("a3", "q")], ["asset_id", "project"]
    )
    got = rw.review_table(case.records, case.variants, case.reg.sources, projects, cf.CODE_CONFLICT)
    first = got.filter("glyph_hash = 'h1'").first()
    assert first["projects"] == "p1, q, p2, q, p3"
    assert rw.review_table(case.records.withColumn("is_false_positive", F.lit(True)), case.variants, case.reg.sources, projects, cf.NAME_CONFLICT).count() == 0


def test_a_run_written_again_leaves_one_set_of_log_rows(spark, tmp_path):
    columns = "glyph_hash string, old_code int, old_hex string, new_code int, new_hex string, reason string"
    changes = lambda *hashes: spark.createDataFrame([(h, 1, "0001", 2, "0002", "r") for h in hashes], columns)
    path = str(tmp_path / "log")
    first = rw.append_lineage(changes("a", "b"), path, "2024-01-02 03:04:05", "run one/2")
    assert first.count() == 2 and first.columns[-1] == "run_at"
    rw.append_lineage(changes("c"), path, "2024-01-03 03:04:05")
    again = rw.append_lineage(changes("a", "b"), path, "2024-01-02 03:04:05", "run one/2")
    assert sorted(r["glyph_hash"] for r in again.collect()) == ["a", "b", "c"]
    # A run that has nothing to say when it is repeated leaves nothing.
    emptied = rw.append_lineage(changes("a").limit(0), path, None, "run one/2")
    assert [r["glyph_hash"] for r in emptied.collect()] == ["c"]
