"""The registry: one entry per fingerprint, with its lists kept as rows.

A fingerprint may be shared by a third of all glyph rows, so aliases, alias
details and sources are tables keyed by ``glyph_hash`` and never one array.
Every aggregate combines on the map side; no window and no list per hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphledger.functions.codes import EMPTY_HASH, code_to_hex
from glyphledger.session import materialize


@dataclass(frozen=True)
class Registry:
    entries: DataFrame  # one row per glyph_hash
    aliases: DataFrame  # glyph_hash, alias
    sources: DataFrame  # glyph_hash, asset_id, original_code, src_ord


def by_hash(glyphs: DataFrame) -> DataFrame:
    """Group sizes per fingerprint."""
    return glyphs.groupBy("glyph_hash").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("asset_id").alias("assets")
    )


def _most(value: Column, n: str, first: str) -> Column:
    """The value counted most often; the first one met wins a tie."""
    return F.min_by(value, F.struct((-F.col(n)).alias("n"), F.col(first).alias("o")))


def fine_counts(glyphs: DataFrame) -> DataFrame:
    """Rows per (fingerprint, code, name, asset), when the first was seen and its measures.

    The one pass over the glyph rows: everything in the registry follows from it.
    With a numeric ``ord`` all values are plain numbers (the type stands as a hash,
    see ``type_names``), so Spark sums in hash tables and sorts no glyph row.
    """
    return (
        glyphs.withColumn("name", F.coalesce("icon_name", F.lit("")))
        .groupBy("glyph_hash", "code", "name", "asset_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ord").alias("o"),
            F.min_by("advance_width", "ord").alias("advance_width"),
            F.min_by("num_contours", "ord").alias("num_contours"),
            F.min_by(F.xxhash64("glyph_type"), "ord").alias("type_mark"),
        )
    )


def type_names(glyphs: DataFrame) -> DataFrame:
    """(type_mark, glyph_type): the few glyph types by their hash."""
    return glyphs.select(F.xxhash64("glyph_type").alias("type_mark"), "glyph_type").distinct()


def canonical_of(fine: DataFrame) -> DataFrame:
    """Most frequent code, then its most frequent name, then their most frequent asset.

    The counts are rolled up three times: each level keeps the best value of the
    level below, so nothing is joined back.
    """
    counted = fine.filter(F.col("glyph_hash") != EMPTY_HASH)
    names = counted.groupBy("glyph_hash", "code", "name").agg(
        F.sum("n").alias("n2"), F.min("o").alias("o2"), _most(F.col("asset_id"), "n", "o").alias("asset_id")
    )
    codes = names.groupBy("glyph_hash", "code").agg(
        F.sum("n2").alias("n1"),
        F.min("o2").alias("o1"),
        _most(F.struct("name", "asset_id"), "n2", "o2").alias("best"),
    )
    return (
        codes.groupBy("glyph_hash")
        .agg(_most(F.struct("code", "best"), "n1", "o1").alias("pick"))
        .select("glyph_hash", "pick.code", "pick.best.name", "pick.best.asset_id")
    )


def select_canonical(glyphs: DataFrame) -> DataFrame:
    return canonical_of(fine_counts(glyphs))


def aliases_of(fine: DataFrame) -> DataFrame:
    """Distinct non-empty names per fingerprint."""
    named = fine.filter((F.col("glyph_hash") != EMPTY_HASH) & (F.col("name") != ""))
    return named.select("glyph_hash", F.col("name").alias("alias")).distinct()


def sources_of(fine: DataFrame) -> DataFrame:
    """One row per (fingerprint, asset) with the code seen first and when."""
    return (
        fine.groupBy("glyph_hash", "asset_id")
        .agg(F.min(F.struct("o", "code")).alias("_first"))
        .select(
            "glyph_hash",
            "asset_id",
            F.col("_first.code").alias("original_code"),
            F.col("_first.o").alias("src_ord"),
        )
    )


def aliases(glyphs: DataFrame) -> DataFrame:
    return aliases_of(fine_counts(glyphs))


def alias_details(glyphs: DataFrame) -> DataFrame:
    """Every named row of a fingerprint in first-seen order (``ord``); duplicates stay."""
    return glyphs.filter(
        (F.col("glyph_hash") != EMPTY_HASH) & (F.col("icon_name") != "")
    ).select(
        "glyph_hash", "ord", "asset_id", "icon_name", "code", code_to_hex(F.col("code")).alias("code_hex")
    )


def sources(glyphs: DataFrame) -> DataFrame:
    return sources_of(fine_counts(glyphs))


def source_details(sources_df: DataFrame, assets: DataFrame) -> DataFrame:
    """Sources with the asset's stylesheet address; null where the asset is unknown."""
    return sources_df.join(assets.select("asset_id", "css_url"), "asset_id", "left")


def source_projects(sources_df: DataFrame, asset_projects: DataFrame) -> DataFrame:
    """(glyph_hash, asset_id, project)."""
    return sources_df.select("glyph_hash", "asset_id").join(asset_projects, "asset_id").select(
        "glyph_hash", "asset_id", "project"
    )


def outlines(glyphs: DataFrame) -> DataFrame:
    """Contours of the first row of each fingerprint, kept apart from the slim entries."""
    return (
        glyphs.filter(F.col("glyph_hash") != EMPTY_HASH)
        .groupBy("glyph_hash")
        .agg(F.min_by("contours", "ord").alias("contours"))
    )


def build_registry(glyphs: DataFrame) -> Registry:
    """Entries in registry order (``ord_major``, ``glyph_hash``) and their row lists.

    The fine counts are written once, so the glyph rows are read and shuffled once.
    """
    fine = materialize(fine_counts(glyphs))
    alias_rows = aliases_of(fine)
    source_rows = sources_of(fine)
    first = (
        fine.filter(F.col("glyph_hash") != EMPTY_HASH)
        .groupBy("glyph_hash")
        .agg(
            F.min_by("advance_width", "o").alias("advance_width"),
            F.min_by("num_contours", "o").alias("num_contours"),
            F.min_by("type_mark", "o").alias("type_mark"),
        )
        .join(type_names(glyphs), "type_mark")
    )
    alias_n = alias_rows.groupBy("glyph_hash").agg(F.count(F.lit(1)).alias("alias_count"))
    source_n = source_rows.groupBy("glyph_hash").agg(F.count(F.lit(1)).alias("source_count"))
    empty = F.col("glyph_hash") == EMPTY_HASH
    entries = (
        source_n.join(canonical_of(fine), "glyph_hash", "left")
        .join(first, "glyph_hash", "left")
        .join(alias_n, "glyph_hash", "left")
        .select(
            "glyph_hash",
            "code",
            code_to_hex(F.col("code")).alias("code_hex"),
            "name",
            "asset_id",
            F.when(empty, EMPTY_HASH).otherwise(F.col("glyph_type")).alias("glyph_type"),
            F.when(empty, 0).otherwise(F.col("num_contours")).alias("num_contours"),
            "advance_width",
            F.coalesce("alias_count", F.lit(0)).alias("alias_count"),
            "source_count",
            F.coalesce("code", F.lit(0)).cast("long").alias("ord_major"),
        )
    )
    return Registry(entries, alias_rows, source_rows)


def unicode_map(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("code").isNotNull()).select("glyph_hash", "code")


def hash_index(entries: DataFrame) -> DataFrame:
    return entries.select(
        "glyph_hash", "code", "code_hex", "name", "asset_id", "alias_count", "source_count", "glyph_type"
    )


def lineage(reg: Registry) -> DataFrame:
    """One row per (entry, source): the long form of the lineage list."""
    head = reg.entries.select("glyph_hash", "code", "code_hex", "name", F.col("asset_id").alias("canonical_asset_id"))
    return head.join(reg.sources.select("glyph_hash", "asset_id", "original_code"), "glyph_hash")


def registry_summary(entries: DataFrame) -> DataFrame:
    n = F.col("source_count")
    total, multi = F.count(F.lit(1)), F.count_if(n > 1)
    return entries.agg(
        total.alias("total_entries"),
        F.count_if(F.col("glyph_type") == "simple").alias("simple"),
        F.count_if(F.col("glyph_type") == "empty").alias("empty"),
        multi.alias("multi_source_entries"),
        F.max(n).alias("max_sources_per_entry"),
        F.sum("alias_count").alias("total_aliases"),
        (total - multi).alias("single_source"),
        F.count_if(n.between(2, 5)).alias("two_to_five"),
        F.count_if(n.between(6, 10)).alias("six_to_ten"),
        F.count_if(n > 10).alias("eleven_plus"),
    )


def top_duplicates(entries: DataFrame, k: int = 10) -> DataFrame:
    """The k entries with the most sources; registry order breaks ties."""
    return (
        entries.orderBy(F.desc("source_count"), "ord_major", "glyph_hash")
        .limit(k)
        .select(
            "glyph_hash",
            F.coalesce(F.nullif("name", F.lit("")), F.lit("(empty)")).alias("name"),
            "source_count",
            "alias_count",
        )
    )


def top_aliases(reg: Registry, k: int = 10, shown: int = 5) -> DataFrame:
    """The k entries with the most aliases and a preview of the first names."""
    top = (
        reg.entries.orderBy(F.desc("alias_count"), "ord_major", "glyph_hash")
        .limit(k)
        .select("glyph_hash", "name", "alias_count")
    )
    # A rank limit inside each hash is applied before the shuffle, so at most
    # ``shown`` rows per hash and task move.
    by_name = Window.partitionBy("glyph_hash").orderBy("alias")
    preview = (
        reg.aliases.join(top.select("glyph_hash"), "glyph_hash", "left_semi")
        .withColumn("_r", F.row_number().over(by_name))
        .filter(F.col("_r") <= shown)
        .groupBy("glyph_hash")
        .agg(F.array_join(F.array_sort(F.collect_list("alias")), ", ").alias("_names"))
    )
    more = F.col("alias_count") - shown
    return top.join(preview, "glyph_hash", "left").select(
        "glyph_hash",
        F.coalesce(F.nullif("name", F.lit("")), F.lit("(empty)")).alias("name"),
        "alias_count",
        F.concat(
            F.coalesce("_names", F.lit("")),
            F.when(more > 0, F.format_string(" ... (+%d)", more)).otherwise(""),
        ).alias("preview"),
    )


def name_listing(entries: DataFrame, k: int = 100) -> DataFrame:
    """The first k names by code text, blanks last; registry order breaks ties."""
    hex_text = F.coalesce("code_hex", F.lit(""))
    return (
        entries.orderBy(hex_text == "", hex_text, "ord_major", "glyph_hash")
        .limit(k)
        .select("glyph_hash", "name", hex_text.alias("code_hex"), "source_count")
    )


def private_code_count(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("code_hex").startswith("E") & (F.length("code_hex") == 4)).alias("private_codes"),
    )
