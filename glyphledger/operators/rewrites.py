"""Rewrite the registry itself: merges by name, then new codes in three passes."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphledger.functions.codes import PRIVATE_HI, PRIVATE_LO, code_to_hex
from glyphledger.operators.allocation import allocate
from glyphledger.operators.conflicts import (
    CODE_CONFLICT,
    DUPLICATE,
    NAME_CONFLICT,
)
from glyphledger.operators.ordering import number_rows
from glyphledger.operators.registry import Registry
from glyphledger.operators.resolution import (
    ITEM,
    first_codes,
    item_members,
    item_sources,
    merge_variants,
)
from glyphledger.session import materialize

# Appended rows sort after every registry row.
APPENDED = 1 << 40


def name_merges(records: DataFrame, variants: DataFrame, decisions: DataFrame) -> DataFrame:
    """Members of every name merge: false positives whole, and the groups reviewers made."""
    named = records.filter(F.col("type") == NAME_CONFLICT)
    members = item_members(named, variants, decisions)
    return members.filter(F.col("resolution").isin("false_positive_merged", "group_kept", "group_pua"))


def apply_name_resolution(
    reg: Registry,
    records: DataFrame,
    variants: DataFrame,
    decisions: DataFrame,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> Registry:
    """Replace the entries a name merge consumed by one merged entry each.

    A kept group keeps the name; the n-th group that leaves it is called
    ``_v<n+1>`` and gets one new code. Entries outside any group stay.
    """
    members = materialize(name_merges(records, variants, decisions))
    # Appended rows keep the order of their records and groups, however many a record has.
    items = number_rows(merge_variants(members), ITEM, "_place")
    leaving = items.filter(F.col("resolution") == "group_pua")
    # One row per reviewer group, so the window is as small as the review was.
    nth = Window.partitionBy("k1").orderBy("k2")
    new = allocate(
        leaving.select(*ITEM, F.row_number().over(nth).alias("nth")), ITEM, None, lo, hi
    )
    consumed = members.select("glyph_hash").distinct()
    gone = F.col("resolution") == "group_pua"
    merged_sources = item_sources(members, reg.sources)
    source_n = merged_sources.groupBy(*ITEM).agg(F.count(F.lit(1)).alias("source_count"))
    alias_n = (
        members.select(*ITEM, F.coalesce("name", F.lit("")).alias("alias"))
        .distinct()
        .groupBy(*ITEM)
        .agg(F.count(F.lit(1)).alias("alias_count"))
    )
    added = (
        items.join(new, ITEM, "left")
        .join(first_codes(reg.sources), "glyph_hash", "left")
        .join(source_n, ITEM, "left")
        .join(alias_n, ITEM, "left")
        .select(
            "glyph_hash",
            F.when(gone, F.col("new_code")).otherwise(F.col("first_code")).alias("code"),
            F.when(gone, code_to_hex(F.col("new_code")))
            .otherwise(F.coalesce("code_hex", F.lit("")))
            .alias("code_hex"),
            F.concat(
                F.col("key"),
                F.when(gone, F.concat(F.lit("_v"), (F.col("nth") + 1).cast("string"))).otherwise(""),
            ).alias("name"),
            F.lit(None).cast("string").alias("asset_id"),
            F.lit("simple").alias("glyph_type"),
            F.lit(None).cast("int").alias("num_contours"),
            "advance_width",
            "alias_count",
            F.coalesce("source_count", F.lit(0)).alias("source_count"),
            (F.lit(APPENDED) + F.col("_place")).alias("ord_major"),
        )
    )
    entries = reg.entries.join(consumed, "glyph_hash", "left_anti").unionByName(added)

    owner = items.select(*ITEM, "glyph_hash")
    aliases = reg.aliases.join(consumed, "glyph_hash", "left_anti").unionByName(
        members.select(*ITEM, F.coalesce("name", F.lit("")).alias("alias"))
        .distinct()
        .join(owner, ITEM)
        .select("glyph_hash", "alias")
    )
    # Both sides carry the same order struct: (list position, variant position, first seen).
    as_placed = F.struct(
        F.lit(0).cast("long").alias("list_pos"),
        F.lit(0).cast("long").alias("pos"),
        F.col("src_ord").alias("src_ord"),
    )
    sources = (
        reg.sources.join(consumed, "glyph_hash", "left_anti")
        .select("glyph_hash", "asset_id", "original_code", as_placed.alias("src_ord"))
        .unionByName(
            merged_sources.join(owner, ITEM).select(
                "glyph_hash", "asset_id", "original_code", F.col("src_at").alias("src_ord")
            )
        )
    )
    return Registry(entries, aliases, sources)


def name_resolution_stats(
    records: DataFrame, variants: DataFrame, decisions: DataFrame
) -> DataFrame:
    """Merged whole, merged by decision, codes given and records left alone."""
    items = merge_variants(name_merges(records, variants, decisions))
    named = records.filter(F.col("type") == NAME_CONFLICT)
    by_record = items.groupBy("k1").agg(
        F.bool_or(F.col("resolution") == "false_positive_merged").alias("fp"),
        F.count_if(F.col("resolution") == "group_pua").alias("pua"),
    )
    return (
        named.join(by_record, named["rid"] == by_record["k1"], "left")
        .agg(
            F.count_if(F.coalesce("fp", F.lit(False))).alias("fp_merged"),
            F.count_if(~F.coalesce("fp", F.lit(True))).alias("decision_merged"),
            F.coalesce(F.sum("pua"), F.lit(0)).alias("codes_given"),
            F.count_if(F.col("fp").isNull()).alias("skipped"),
        )
    )


CHANGE = ["glyph_hash", "old_code", "old_hex", "new_code", "new_hex", "reason"]


def _changes(requests: DataFrame, order: list[str], used: DataFrame, lo: int, hi: int) -> DataFrame:
    given = allocate(requests, order, used, lo, hi)
    return given.select(
        "glyph_hash",
        F.col("code").alias("old_code"),
        F.col("code_hex").alias("old_hex"),
        "new_code",
        code_to_hex(F.col("new_code")).alias("new_hex"),
        "reason",
    )


def _reason(kind: str) -> Column:
    return F.concat(F.lit(f"Type A {kind}resolution for "), F.col("key"))


def _review(records: DataFrame, variants: DataFrame) -> DataFrame:
    heads = records.filter(F.col("type") == CODE_CONFLICT).select("group_id", "rid", "key")
    return variants.drop("type", "code", "code_hex", "source_count").join(heads, "group_id")


def code_requests_user(
    entries: DataFrame, records: DataFrame, variants: DataFrame, decisions: DataFrame
) -> DataFrame:
    """Every variant a reviewer moved away, in decision order."""
    moved = decisions.filter((F.col("form") == "groups") & (F.col("group_type") == "pua"))
    return (
        _review(records, variants)
        .select("rid", "pos", "key", "glyph_hash")
        .join(moved.select("rid", "pos", "group_no", "list_pos"), ["rid", "pos"])
        .join(entries.select("glyph_hash", "code", "code_hex"), "glyph_hash")
        .withColumn("reason", _reason("conflict "))
    )


def apply_code_user(
    entries: DataFrame,
    records: DataFrame,
    variants: DataFrame,
    decisions: DataFrame,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> DataFrame:
    """First pass: one new code per moved variant; codes in the registry are not reused."""
    return _changes(
        code_requests_user(entries, records, variants, decisions),
        ["rid", "group_no", "list_pos", "pos"],
        entries.select("code"),
        lo,
        hi,
    )


def skipped_decisions(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decided record ids that the code review does not hold."""
    held = records.filter(F.col("type") == CODE_CONFLICT).select("rid")
    return decisions.select("rid").distinct().join(held, "rid", "left_anti")


def with_changes(entries: DataFrame, changes: DataFrame) -> DataFrame:
    """Entries with their changed codes."""
    new = changes.select("glyph_hash", "new_code", "new_hex")
    return (
        entries.join(new, "glyph_hash", "left")
        .withColumn("code", F.coalesce("new_code", "code"))
        .withColumn("code_hex", F.coalesce("new_hex", "code_hex"))
        .drop("new_code", "new_hex")
    )


def code_keepers(
    entries: DataFrame, records: DataFrame, variants: DataFrame, decisions: DataFrame
) -> DataFrame:
    """(rid, keep_pos): the variant of each record that keeps the code.

    Undecided: most sources. All variants grouped: the first keep group, its
    best member if it has several. Partly grouped: the first member of the
    first keep group. Otherwise the first variant.
    """
    counts = entries.select("glyph_hash", "source_count")
    v = (
        _review(records, variants)
        .select("rid", "pos", "glyph_hash")
        .join(counts, "glyph_hash", "left")
        .withColumn("_n", F.coalesce("source_count", F.lit(0)))
    )
    best = F.min_by("pos", F.struct((-F.col("_n")).alias("n"), F.col("pos").alias("p")))
    overall = v.groupBy("rid").agg(F.count(F.lit(1)).alias("variant_count"), best.alias("best"))

    groups = decisions.filter(F.col("form") == "groups")
    decided = decisions.select("rid").distinct().withColumn("decided", F.lit(True))
    grouped = (
        groups.select("rid", "pos")
        .distinct()
        .join(v.select("rid", "pos"), ["rid", "pos"])
        .groupBy("rid")
        .agg(F.count(F.lit(1)).alias("grouped"))
    )
    first_keep = (
        groups.filter(F.col("group_type") == "keep")
        .groupBy("rid")
        .agg(F.min("group_no").alias("group_no"))
    )
    # Listed order decides a tie inside the keep group.
    in_keep = (
        groups.join(first_keep, ["rid", "group_no"], "left_semi")
        .join(v, ["rid", "pos"])
        .groupBy("rid")
        .agg(
            F.min_by("pos", F.struct((-F.col("_n")).alias("n"), "list_pos", "pos")).alias("keep_best"),
            F.min_by("pos", F.struct("list_pos", "pos")).alias("keep_first"),
        )
    )
    keep = (
        F.when(F.col("decided").isNull(), F.col("best"))
        .when(F.col("grouped") == F.col("variant_count"), F.col("keep_best"))
        .otherwise(F.col("keep_first"))
    )
    return (
        overall.join(decided, "rid", "left")
        .join(grouped, "rid", "left")
        .join(in_keep, "rid", "left")
        .select("rid", F.coalesce(keep, F.lit(0)).cast("long").alias("keep_pos"))
    )


def apply_code_auto(
    entries: DataFrame,
    records: DataFrame,
    variants: DataFrame,
    decisions: DataFrame,
    used: DataFrame,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> DataFrame:
    """Second pass: variants still on the keeper's code get a new one.

    ``entries`` carry the codes after the first pass; ``used`` holds every code
    ever taken (the original ones and those given so far).
    """
    v = (
        _review(records, variants)
        .select("rid", "pos", "key", "glyph_hash")
        .join(entries.select("glyph_hash", "code", "code_hex"), "glyph_hash")
    )
    keepers = code_keepers(entries, records, variants, decisions)
    keep_code = (
        _review(records, variants)
        .select("rid", "pos", "glyph_hash")
        .join(keepers, "rid")
        .filter(F.col("pos") == F.col("keep_pos"))
        .join(entries.select("glyph_hash", F.col("code").alias("keep_code")), "glyph_hash", "left")
        .select("rid", "keep_pos", "keep_code")
    )
    stay = F.col("keep_code").isNull() | F.col("code").eqNullSafe(F.col("keep_code"))
    requests = (
        v.join(keep_code, "rid")
        .filter((F.col("pos") != F.col("keep_pos")) & stay)
        .withColumn("reason", _reason("auto "))
    )
    return _changes(requests, ["rid", "pos"], used, lo, hi)


def apply_code_fallback(
    entries: DataFrame,
    records: DataFrame,
    variants: DataFrame,
    updated: DataFrame,
    used: DataFrame,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> DataFrame:
    """Third pass over freshly detected conflicts: per current code the first variant stays.

    These records carry no source counts, so order alone decides.
    """
    v = (
        _review(records, variants)
        .select("rid", "pos", "key", "glyph_hash")
        .join(entries.select("glyph_hash", "code", "code_hex"), "glyph_hash")
    )
    firsts = v.groupBy(F.col("rid").alias("_rid"), F.col("code").alias("_code")).agg(
        F.min("pos").alias("first_pos")
    )
    requests = (
        v.join(firsts, (F.col("rid") == F.col("_rid")) & F.col("code").eqNullSafe(F.col("_code")))
        .drop("_rid", "_code")
        .filter(F.col("pos") > F.col("first_pos"))
        .join(updated.select("glyph_hash").distinct(), "glyph_hash", "left_anti")
        .withColumn("reason", _reason("fallback "))
    )
    return _changes(requests, ["rid", "first_pos", "pos"], used, lo, hi)


def lineage_log(changes: DataFrame) -> DataFrame:
    """Log rows of code changes; ``append_lineage`` adds the time of the run."""
    return changes.select(
        "glyph_hash", F.lit("assign_pua").alias("action"), "old_code", "old_hex", "new_code", "new_hex", "reason"
    )


def append_lineage(changes: DataFrame, path: str, at: str | None = None, run: str | None = None) -> DataFrame:
    """Put the log rows of one run into the lineage log at ``path`` and return the whole log.

    A run has a folder of its own in the log, named by ``run`` (by default after
    ``at``, else a new name), and writes that folder anew: running again after a
    failure, with the same name, changes nothing, and other runs stay as they are.
    Every row carries the time of its run: ``at`` in ISO form, or the moment the run
    was planned.
    """
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    name = run if run is not None else at if at is not None else uuid.uuid4().hex
    rows = lineage_log(changes).withColumn("run_at", moment)
    # Hive-style folder names escape other characters; a digest keeps names apart.
    folder = name if re.fullmatch(r"[A-Za-z0-9_.-]+", name) else hashlib.sha256(name.encode()).hexdigest()
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={folder}")
    schema = T.StructType([*rows.schema.fields, T.StructField("run", T.StringType())])
    return changes.sparkSession.read.schema(schema).parquet(path).drop("run")


def name_first_effect(records: DataFrame, variants: DataFrame) -> DataFrame:
    """Code conflicts after merging falsely different names: one row per record.

    ``outcome`` is eliminated, modified (still a conflict but changed) or remaining.
    """
    fp_names = records.filter(
        (F.col("type") == NAME_CONFLICT) & F.coalesce("is_false_positive", F.lit(False))
    ).select("group_id", F.col("key").alias("name"))
    first = (
        variants.filter(F.col("pos") == 0)
        .select("group_id", F.col("glyph_hash").alias("canonical"))
        .join(fp_names, "group_id")
        .select("name", "canonical")
    )
    code_v = records.filter(F.col("type") == CODE_CONFLICT).select("group_id", "key").join(
        variants.select("group_id", "glyph_hash", "name"), "group_id"
    )
    return (
        code_v.join(first, "name", "left")
        .withColumn("now", F.coalesce("canonical", "glyph_hash"))
        .groupBy("group_id", "key")
        .agg(
            F.countDistinct("now").alias("hashes_left"),
            F.bool_or(F.col("now") != F.col("glyph_hash")).alias("changed"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("hashes_left") <= 1, "eliminated")
            .when(F.col("changed"), "modified")
            .otherwise("remaining"),
        )
        .select("group_id", "key", "hashes_left", "outcome")
    )


def name_first_summary(effect: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    gone = F.count_if(F.col("outcome") == "eliminated")
    return effect.agg(
        total.alias("type_a_total"),
        gone.alias("eliminated"),
        (total - gone).alias("remaining"),
        F.count_if(F.col("outcome") == "modified").alias("modified"),
        F.round(gone * 100.0 / total, 1).alias("eliminated_pct"),
        F.round((total - gone) * 100.0 / total, 1).alias("remaining_pct"),
    )


def review_queue(records: DataFrame, effect: DataFrame) -> DataFrame:
    """What is left to review: remaining code conflicts, real name conflicts, duplicates."""
    gone = effect.filter(F.col("outcome") == "eliminated").select("group_id")
    fp_name = (F.col("type") == NAME_CONFLICT) & F.coalesce("is_false_positive", F.lit(False))
    return records.filter(~fp_name).join(gone, "group_id", "left_anti")


def review_queue_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("type").agg(F.count(F.lit(1)).alias("records"))


def review_table(
    records: DataFrame,
    variants: DataFrame,
    sources: DataFrame,
    asset_projects: DataFrame,
    kind: str | None = None,
    shown: int = 5,
) -> DataFrame:
    """A row per variant to review, with its first projects in source order."""
    wanted = records.filter(F.col("type") != DUPLICATE)
    if kind:
        wanted = wanted.filter(F.col("type") == kind)
    if kind == NAME_CONFLICT:
        wanted = wanted.filter(~F.coalesce("is_false_positive", F.lit(False)))
    rows = variants.drop("type").join(
        wanted.select("group_id", "rid", "type", "severity", "key", "variant_count"), "group_id"
    )
    # Rank limit per hash: pruned before the shuffle.
    first = Window.partitionBy("glyph_hash").orderBy("src_ord", "project")
    names = (
        sources.join(asset_projects, "asset_id")
        .withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= shown)
        .groupBy("glyph_hash")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_r", "project"))), lambda p: p["project"]
                ),
                ", ",
            ).alias("projects")
        )
    )
    return rows.join(names, "glyph_hash", "left").select(
        F.col("rid").alias("id"),
        "type",
        "severity",
        "key",
        "variant_count",
        "pos",
        "glyph_hash",
        F.coalesce(F.nullif("name", F.lit("")), F.lit("(none)")).alias("name"),
        "source_count",
        F.coalesce("projects", F.lit("")).alias("projects"),
    )


