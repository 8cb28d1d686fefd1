"""Conflicts between registry entries, as record rows and variant rows.

A record is one row; its variants, assets and projects are rows of their own,
because one code or name may cover a large part of the registry. ``group_id``
ties them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.codes import SEVERITY_ORDER, severity, severity_rank
from glyphledger.operators.ordering import number_rows, number_within

# Conflict types in report order, and the hint each one carries.
CODE_CONFLICT = "unicode_conflict"
NAME_CONFLICT = "name_conflict"
DUPLICATE = "glyph_duplicate"
HINTS = {CODE_CONFLICT: "assign_pua", NAME_CONFLICT: "rename", DUPLICATE: "merge_alias"}
TYPE_ORDER = (CODE_CONFLICT, NAME_CONFLICT, DUPLICATE)


def code_group() -> Column:
    return F.concat(F.lit("c"), F.col("code").cast("string"))


def name_group() -> Column:
    return F.concat(F.lit("n"), F.col("name"))


def hash_group() -> Column:
    return F.concat(F.lit("h"), F.col("glyph_hash"))


def _record(kind: str, severity_of: Column) -> list[Column]:
    return [
        F.lit(kind).alias("type"),
        severity(severity_of).alias("severity"),
        F.col("key"),
        F.col("variant_count"),
        F.lit(HINTS[kind]).alias("resolution_hint"),
        F.col("group_id"),
    ]


def _shared(entries: DataFrame, group: Column, key: Column, kind: str) -> DataFrame:
    """Groups of entries that hold more than one fingerprint."""
    order = F.struct("ord_major", "glyph_hash")
    return (
        entries.withColumn("group_id", group)
        .groupBy("group_id")
        .agg(
            F.count(F.lit(1)).alias("variant_count"),
            F.min("glyph_hash").alias("_lo"),
            F.max("glyph_hash").alias("_hi"),
            F.min_by(key, order).alias("key"),
        )
        .filter(F.col("_lo") != F.col("_hi"))
        .select(*_record(kind, F.col("variant_count")))
    )


def code_conflicts(entries: DataFrame) -> DataFrame:
    """One code, several fingerprints."""
    return _shared(
        entries.filter(F.col("code").isNotNull()),
        code_group(),
        F.concat(F.lit("U+"), F.col("code_hex")),
        CODE_CONFLICT,
    )


def name_conflicts(entries: DataFrame) -> DataFrame:
    """One name, several fingerprints; blank names do not count."""
    return _shared(entries.filter(F.col("name") != ""), name_group(), F.col("name"), NAME_CONFLICT)


def duplicates(entries: DataFrame) -> DataFrame:
    """One fingerprint with several sources; graded by the number of sources."""
    return (
        entries.filter(F.col("source_count") > 1)
        .withColumns(
            {"key": F.col("glyph_hash"), "variant_count": F.lit(1).cast("long"), "group_id": hash_group()}
        )
        .select(*_record(DUPLICATE, F.col("source_count")))
    )


def all_conflicts(entries: DataFrame) -> DataFrame:
    """Every conflict with its sort columns: severity, key, then type."""
    type_rank = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), F.col("type"))
    return (
        code_conflicts(entries)
        .unionByName(name_conflicts(entries))
        .unionByName(duplicates(entries))
        .withColumn("severity_rank", severity_rank(F.col("severity")))
        .withColumn("type_rank", type_rank.cast("int"))
    )


RECORD_ORDER = ["severity_rank", "key", "type_rank", "group_id"]


def number_records(records: DataFrame) -> DataFrame:
    """Stable record id: the position in the sorted list of all conflicts."""
    return number_rows(records, RECORD_ORDER, "rid")


def conflict_variants(entries: DataFrame, records: DataFrame) -> DataFrame:
    """(group_id, type, pos, entry columns): members of each record in registry order."""
    order = ["ord_major", "glyph_hash"]

    def members(kind: str, group: Column) -> DataFrame:
        wanted = records.filter(F.col("type") == kind).select("group_id", "type")
        return entries.withColumn("group_id", group).join(wanted, "group_id")

    by_code = members(CODE_CONFLICT, code_group())
    by_name = members(NAME_CONFLICT, name_group())
    single = members(DUPLICATE, hash_group()).withColumn("pos", F.lit(0).cast("long"))
    numbered = number_within(by_code.unionByName(by_name), ["group_id", "type"], order, "pos")
    return numbered.unionByName(single)


def affected(variants: DataFrame, sources: DataFrame, asset_projects: DataFrame) -> DataFrame:
    """Distinct (group_id, kind, member): the assets and projects a record touches."""
    assets = (
        variants.select("group_id", "glyph_hash")
        .join(sources.select("glyph_hash", "asset_id"), "glyph_hash")
        .select("group_id", "asset_id")
        .distinct()
    )
    projects = assets.join(asset_projects, "asset_id").select(
        "group_id", F.lit("project").alias("kind"), F.col("project").alias("member")
    )
    return (
        assets.select("group_id", F.lit("asset").alias("kind"), F.col("asset_id").alias("member"))
        .unionByName(projects.distinct())
    )


def conflict_matrix(records: DataFrame) -> DataFrame:
    """Counts by type and severity with totals (``all``)."""
    return (
        records.cube("type", "severity")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(
            F.coalesce("type", F.lit("all")).alias("type"),
            F.coalesce("severity", F.lit("all")).alias("severity"),
            "records",
        )
    )


def conflict_totals(records: DataFrame) -> DataFrame:
    """One row of run totals: all records, per type and per severity."""
    per = [F.count_if(F.col("type") == t).alias(t) for t in TYPE_ORDER]
    per += [F.count_if(F.col("severity") == s).alias(s) for s in SEVERITY_ORDER]
    return records.agg(F.count(F.lit(1)).alias("total_conflicts"), *per)


def entry_collisions(entries: DataFrame, column: str) -> DataFrame:
    """Values of a column shared by more than one entry, whatever their fingerprints."""
    return (
        entries.filter(F.col(column) != "")
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("entries"))
        .filter(F.col("entries") > 1)
    )


def residual(conflicts: DataFrame, review: DataFrame) -> DataFrame:
    """Remaining code conflicts, with whether the review set had their key."""
    known = review.select("key").distinct().withColumn("in_review", F.lit(True))
    return (
        conflicts.filter(F.col("type") == CODE_CONFLICT)
        .select("key", "variant_count")
        .join(known, "key", "left")
        .select("key", "variant_count", F.coalesce("in_review", F.lit(False)).alias("in_review"))
    )
