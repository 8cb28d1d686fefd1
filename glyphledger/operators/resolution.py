"""Resolve conflicts from reviewer decisions into one final glyph per fingerprint.

A resolved glyph is an *item*: a false positive merged whole, a group a reviewer
made, a single variant, or a plain registry entry. ``phase`` (0 code, 1 name,
2 plain), ``k1`` and ``k2`` put items into the order in which they are decided.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphledger.functions.codes import PRIVATE_HI, PRIVATE_LO, code_to_hex, key_to_code
from glyphledger.operators.allocation import allocate
from glyphledger.operators.conflicts import CODE_CONFLICT, NAME_CONFLICT
from glyphledger.operators.registry import Registry
from glyphledger.session import materialize

ITEM = ["phase", "k1", "k2"]
PHASE = {CODE_CONFLICT: 0, NAME_CONFLICT: 1}
KEPT = ("kept_original", "group_kept")
ASSIGNED = ("pua_assigned", "group_pua")
MERGED_WHOLE = "false_positive_merged"


@dataclass(frozen=True)
class Resolution:
    glyphs: DataFrame  # one row per glyph_hash, with its item key
    aliases: DataFrame  # glyph_hash, alias
    sources: DataFrame  # glyph_hash, asset_id, original_code, src_ord


def load_decisions(raw: DataFrame) -> DataFrame:
    """Bring the older form (one action for one variant) into the row form.

    Input: rid, unmerge, group_no, group_type, list_pos, pos, action,
    variant_index. Rows with an action but no group become per-variant decisions.
    """
    old = F.col("group_no").isNull() & F.col("action").isNotNull()
    return raw.select(
        "rid",
        F.coalesce("unmerge", F.lit(False)).alias("unmerge"),
        F.when(F.col("group_no").isNotNull(), "groups").otherwise("variants").alias("form"),
        "group_no",
        F.when(old, F.col("action")).otherwise(F.col("group_type")).alias("group_type"),
        F.coalesce("list_pos", F.lit(0)).alias("list_pos"),
        F.when(old, F.col("variant_index")).otherwise(F.col("pos")).cast("long").alias("pos"),
    )


def _branches(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Records with the way they are resolved: fp, groups or single."""
    per_record = decisions.groupBy("rid").agg(
        F.bool_or("unmerge").alias("unmerge"), F.max("form").alias("_v"), F.min("form").alias("_g")
    )
    fp = F.coalesce("is_false_positive", F.lit(False)) & ~F.coalesce("unmerge", F.lit(False))
    return records.join(per_record, "rid", "left").withColumn(
        "branch",
        F.when(fp, "fp").when(F.col("_g") == "groups", "groups").otherwise("single"),
    ).drop("_v", "_g", "unmerge")


def item_members(records: DataFrame, variants: DataFrame, decisions: DataFrame) -> DataFrame:
    """(phase, k1, k2, list_pos, ..., resolution, auto): the variants of every item."""
    heads = _branches(records, decisions).select("rid", "group_id", "key", "type", "branch")
    v = variants.drop("type").join(heads, "group_id")

    whole = v.filter(F.col("branch") == "fp").select(
        "*",
        F.lit(0).cast("long").alias("k2"),
        F.col("pos").alias("list_pos"),
        F.lit(MERGED_WHOLE).alias("resolution"),
        F.lit(False).alias("auto"),
    )

    grouped = decisions.filter(F.col("form") == "groups").join(
        v.filter(F.col("branch") == "groups"), ["rid", "pos"]
    )
    # Groups that hold no known variant are not counted; there is one row per group here.
    kept_groups = grouped.select("rid", "group_no").distinct()
    index = kept_groups.withColumn(
        "k2", (F.row_number().over(Window.partitionBy("rid").orderBy("group_no")) - 1).cast("long")
    )
    groups = (
        grouped.join(index, ["rid", "group_no"])
        .withColumn(
            "resolution",
            F.when(F.col("group_type") == "keep", "group_kept").otherwise("group_pua"),
        )
        .withColumn("auto", F.lit(False))
        .withColumn("list_pos", F.col("list_pos").cast("long"))
    )

    choices = decisions.filter(F.col("form") == "variants").select("rid", "pos", "group_type")
    single = (
        v.filter(F.col("branch") == "single")
        .join(choices, ["rid", "pos"], "left")
        .withColumn("k2", F.col("pos"))
        .withColumn("list_pos", F.lit(0).cast("long"))
        .withColumn(
            "resolution",
            F.when(F.col("group_type") == "keep", "kept_original").otherwise("pua_assigned"),
        )
        .withColumn("auto", F.col("group_type").isNull())
    )
    cols = [
        "type", "key", "group_id", F.col("rid").alias("k1"), "k2", "list_pos", "pos",
        "glyph_hash", "code", "code_hex", "name", "advance_width", "resolution", "auto",
    ]
    members = whole.select(*cols).unionByName(groups.select(*cols)).unionByName(single.select(*cols))
    return members.withColumn(
        "phase", F.when(F.col("type") == CODE_CONFLICT, 0).otherwise(1)
    )


def merge_variants(members: DataFrame) -> DataFrame:
    """One row per item: the first listed variant stands for it."""
    order = F.struct("list_pos", "pos")
    return (
        members.groupBy(*ITEM, "type", "key", "resolution")
        .agg(
            F.min_by(F.struct("glyph_hash", "name", "code_hex", "advance_width", "pos"), order).alias("p"),
            F.count(F.lit(1)).alias("merged_variant_count"),
            F.bool_or("auto").alias("auto"),
        )
        .select(
            *ITEM, "type", "key", "resolution", "merged_variant_count", "auto",
            "p.glyph_hash", "p.name", "p.code_hex", "p.advance_width", "p.pos",
        )
    )


def item_sources(members: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources of each item, one per asset, in first-seen order."""
    at = F.struct(F.col("list_pos"), F.col("pos"), F.col("src_ord"))
    return (
        members.select(*ITEM, "list_pos", "pos", "glyph_hash")
        .join(sources, "glyph_hash")
        .groupBy(*ITEM, "asset_id")
        .agg(F.min(F.struct(at.alias("at"), F.col("original_code").alias("code"))).alias("f"))
        .select(*ITEM, "asset_id", F.col("f.code").alias("original_code"), F.col("f.at").alias("src_at"))
    )


def item_aliases(members: DataFrame) -> DataFrame:
    """Names each item answers to besides its final one."""
    name = F.coalesce("name", F.lit(""))
    merged = F.col("resolution").isin(MERGED_WHOLE, *("group_kept", "group_pua"))
    by_name = F.col("type") == NAME_CONFLICT
    alias = (
        F.when(by_name & F.col("resolution").isin(*ASSIGNED), F.col("key"))
        .when(merged, F.nullif(name, F.lit("")))
        .when(F.col("resolution") == "pua_assigned", name)
    )
    return (
        members.select(*ITEM, alias.alias("alias")).filter(F.col("alias").isNotNull()).distinct()
    )


def affected_projects(
    glyphs: DataFrame, members: DataFrame, sources: DataFrame, asset_projects: DataFrame
) -> DataFrame:
    """(glyph_hash, project) of the conflict each glyph came from; plain entries have none."""
    decided = glyphs.filter(F.col("phase") < 2).select(*ITEM, F.col("glyph_hash").alias("owner"))
    return (
        members.select(*ITEM, "glyph_hash")
        .join(decided, ITEM)
        .select("glyph_hash", "owner")
        .distinct()
        .join(sources.select("glyph_hash", "asset_id"), "glyph_hash")
        .join(asset_projects, "asset_id")
        .select(F.col("owner").alias("glyph_hash"), "project")
        .distinct()
    )


def first_codes(sources: DataFrame) -> DataFrame:
    """Code of the first source of each fingerprint."""
    return sources.groupBy("glyph_hash").agg(F.min_by("original_code", "src_ord").alias("first_code"))


def _suffix(kind: Column, k2: Column, pos: Column) -> Column:
    return (
        F.when(kind == "group_pua", F.concat(F.lit("_g"), (k2 + 1).cast("string")))
        .when(kind == "pua_assigned", F.concat(F.lit("_v"), (pos + 1).cast("string")))
        .otherwise("")
    )


def resolve_items(
    members: DataFrame, sources: DataFrame, lo: int = PRIVATE_LO, hi: int = PRIVATE_HI
) -> DataFrame:
    """Final code and name of every item; new codes are given in item order.

    The allocator starts at ``lo`` and does not look at codes already in use.
    """
    items = merge_variants(members)
    new = allocate(
        items.filter(F.col("resolution").isin(*ASSIGNED)).select(*ITEM), ITEM, None, lo, hi
    )
    by_code = F.col("type") == CODE_CONFLICT
    assigned = F.col("resolution").isin(*ASSIGNED)
    kept_code = F.when(by_code, key_to_code(F.col("key"))).otherwise(F.col("first_code"))
    kept_hex = F.when(by_code, F.regexp_replace("key", r"U\+", "")).otherwise(
        F.coalesce(F.when(F.col("first_code") != 0, code_to_hex(F.col("first_code"))), F.lit(""))
    )
    base = F.when(by_code, F.coalesce("name", F.lit(""))).otherwise(F.col("key"))
    return (
        items.join(new, ITEM, "left")
        .join(first_codes(sources), "glyph_hash", "left")
        .select(
            *ITEM,
            "glyph_hash",
            F.when(assigned, F.col("new_code")).otherwise(kept_code).alias("final_code"),
            F.when(assigned, code_to_hex(F.col("new_code"))).otherwise(kept_hex).alias("final_hex"),
            F.concat(base, _suffix(F.col("resolution"), F.col("k2"), F.col("pos"))).alias("final_name"),
            "resolution",
            "merged_variant_count",
            F.col("key").alias("conflict_key"),
            F.col("type").alias("conflict_type"),
            "advance_width",
            F.lit("simple").alias("glyph_type"),
            "auto",
        )
    )


def resolve_rest(entries: DataFrame) -> DataFrame:
    """Every registry entry as it stands; those with several sources are alias merges."""
    multi = F.col("source_count") > 1
    return entries.select(
        F.lit(2).alias("phase"),
        F.col("ord_major").alias("k1"),
        F.lit(0).cast("long").alias("k2"),
        "glyph_hash",
        F.col("code").alias("final_code"),
        F.coalesce("code_hex", F.lit("")).alias("final_hex"),
        F.coalesce("name", F.lit("")).alias("final_name"),
        F.when(multi, "alias_merged").otherwise("single_source").alias("resolution"),
        F.lit(None).cast("long").alias("merged_variant_count"),
        F.lit(None).cast("string").alias("conflict_key"),
        F.lit(None).cast("string").alias("conflict_type"),
        "advance_width",
        "glyph_type",
        F.lit(False).alias("auto"),
        F.when(multi, F.col("source_count")).alias("merged_source_count"),
    )


def combine(reg: Registry, members: DataFrame, items: DataFrame) -> Resolution:
    """One glyph per fingerprint: the first item wins, later ones only add unseen sources."""
    rest = resolve_rest(reg.entries)
    every = items.withColumn("merged_source_count", F.lit(None).cast("long")).unionByName(rest)
    fields = [c for c in every.columns if c not in (*ITEM, "glyph_hash")]
    glyphs = (
        every.groupBy("glyph_hash")
        .agg(F.min_by(F.struct(*ITEM, *fields), F.struct(*ITEM)).alias("w"))
        .select("glyph_hash", "w.*")
    )
    winner = glyphs.select("glyph_hash", *ITEM)

    from_items = item_aliases(members).join(winner, ITEM).select("glyph_hash", "alias")
    plain = winner.filter(F.col("phase") == 2).select("glyph_hash")
    aliases = from_items.unionByName(reg.aliases.join(plain, "glyph_hash", "left_semi"))

    # Owners meet the members before the many sources do, so the sources of all items are grouped once.
    owner = items.select(*ITEM, F.col("glyph_hash").alias("owner"))
    decided = (
        members.select(*ITEM, "list_pos", "pos", "glyph_hash")
        .join(owner, ITEM)
        .join(reg.sources, "glyph_hash")
        .select(
            F.col("owner").alias("glyph_hash"),
            "asset_id",
            "original_code",
            F.struct(*ITEM, F.struct("list_pos", "pos", "src_ord").alias("src_at")).alias("at"),
        )
    )
    own = reg.sources.select(
        "glyph_hash",
        "asset_id",
        "original_code",
        F.struct(
            F.lit(2).alias("phase"),
            F.lit(0).cast("long").alias("k1"),
            F.lit(0).cast("long").alias("k2"),
            F.struct(
                F.lit(0).cast("long").alias("list_pos"),
                F.lit(0).cast("long").alias("pos"),
                F.col("src_ord").alias("src_ord"),
            ).alias("src_at"),
        ).alias("at"),
    )
    sources = (
        decided.unionByName(own)
        .groupBy("glyph_hash", "asset_id")
        .agg(F.min(F.struct("at", F.col("original_code").alias("code"))).alias("f"))
        .select(
            "glyph_hash", "asset_id", F.col("f.code").alias("original_code"), F.col("f.at").alias("src_ord")
        )
    )
    return Resolution(glyphs, aliases, sources)


def resolve(
    reg: Registry,
    records: DataFrame,
    variants: DataFrame,
    decisions: DataFrame,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> Resolution:
    """Code conflicts, then name conflicts, then everything else.

    Members and items are written once: the given codes are then fixed for every
    table that follows from them.
    """
    open_records = records.filter(F.col("type").isin(CODE_CONFLICT, NAME_CONFLICT))
    members = materialize(item_members(open_records, variants, decisions))
    items = materialize(resolve_items(members, reg.sources, lo, hi))
    return combine(reg, members, items)


def alias_map(res: Resolution) -> DataFrame:
    """Name or alias to fingerprint; the last glyph in order that claims a name gets it."""
    order = res.glyphs.select("glyph_hash", F.struct(*ITEM, "glyph_hash").alias("at"))
    claims = (
        res.glyphs.filter(F.col("final_name") != "")
        .select("glyph_hash", F.col("final_name").alias("name"))
        .unionByName(res.aliases.select("glyph_hash", F.col("alias").alias("name")))
    )
    return (
        claims.join(order, "glyph_hash").groupBy("name").agg(F.max_by("glyph_hash", "at").alias("glyph_hash"))
    )


def resolution_stats(items: DataFrame, records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Kept, assigned, automatic and merged counts per conflict type.

    An automatic assignment counts as assigned and as automatic, so the total
    of settled conflicts holds it twice.
    """
    r = F.col("resolution")
    per_type = items.groupBy(F.col("conflict_type").alias("type")).agg(
        F.count_if(r.isin(*KEPT)).alias("kept"),
        F.count_if(r.isin(*ASSIGNED)).alias("assigned"),
        F.count_if(F.col("auto")).alias("auto_resolved"),
        F.count_if(r == MERGED_WHOLE).alias("merged_whole"),
    )
    grouped = (
        _branches(records, decisions)
        .filter(F.col("branch") == "groups")
        .select("rid", "type")
        .join(decisions.filter(F.col("form") == "groups").select("rid", "group_no").distinct(), "rid")
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("group_merged"))
    )
    return (
        per_type.join(grouped, "type", "left")
        .withColumn("group_merged", F.coalesce("group_merged", F.lit(0)))
        .withColumn(
            "settled",
            F.col("kept") + F.col("assigned") + F.col("auto_resolved") + F.col("merged_whole") + F.col("group_merged"),
        )
    )


def code_range_used(items: DataFrame) -> DataFrame:
    new = items.filter(F.col("resolution").isin(*ASSIGNED))
    return new.agg(
        F.count(F.lit(1)).alias("codes_assigned"),
        F.concat_ws(
            "-",
            F.concat(F.lit("U+"), code_to_hex(F.min("final_code"))),
            F.concat(F.lit("U+"), code_to_hex(F.max("final_code"))),
        ).alias("range_used"),
    )


def resolution_histogram(glyphs: DataFrame) -> DataFrame:
    return glyphs.groupBy("resolution").agg(F.count(F.lit(1)).alias("glyphs"))
