"""Checks on assets and on the final registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.operators.conflicts import code_conflicts, name_conflicts
from glyphledger.operators.ordering import side_by_side


def validate_assets(assets: DataFrame, mappings: DataFrame, sniffed: DataFrame) -> DataFrame:
    """Status and issues per asset.

    ``assets`` has css_path, css_size (null if the file is gone), ttf_path and
    download_status; ``sniffed`` has size, valid and reason of the font files
    that exist. A corrupt font outranks a missing stylesheet, then a missing
    font file, then empty mappings. An asset without a font path has no font
    issue.
    """
    j = assets.join(
        sniffed.select("asset_id", F.col("size").alias("ttf_size"), "valid", "reason"), "asset_id", "left"
    ).join(mappings.select("asset_id", "mapping_count"), "asset_id", "left")
    count = F.coalesce("mapping_count", F.lit(0))
    has_font = F.col("ttf_path").isNotNull()
    gone = has_font & F.col("ttf_size").isNull()
    corrupt = has_font & ~F.coalesce("valid", F.lit(True))
    expects = F.col("download_status") != "css_404"
    issues = F.array_compact(
        F.array(
            F.when(F.col("css_path").isNull(), "css_path_missing").when(
                F.col("css_size").isNull(), "css_file_missing"
            ),
            F.when(corrupt, F.concat(F.lit("ttf_corrupt: "), F.col("reason"))),
            F.when(gone, "ttf_file_missing"),
            F.when(gone, "ttf_not_downloaded"),
            F.when(expects & (count == 0), "empty_mappings"),
        )
    )
    status = (
        F.when(corrupt, "ttf_corrupt")
        .when(~expects, "css_404")
        .when(gone, "ttf_missing")
        .when(count == 0, "empty_mappings")
        .otherwise("ok")
    )
    return j.select(
        "asset_id",
        F.coalesce("css_size", F.lit(0)).alias("css_size"),
        F.coalesce("ttf_size", F.lit(0)).alias("ttf_size"),
        F.col("ttf_size").isNotNull().alias("ttf_exists"),
        F.when(expects, count).otherwise(0).alias("mapping_count"),
        issues.alias("issues"),
        status.alias("status"),
    )


def status_summary(checked: DataFrame) -> DataFrame:
    """Counts per status; empty mappings count even where a worse status won."""
    status = F.col("status")
    return checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "ok").alias("ok"),
        F.count_if(status == "css_404").alias("css_404"),
        F.count_if(status == "ttf_missing").alias("ttf_missing"),
        F.count_if(F.array_contains("issues", "empty_mappings")).alias("empty_mappings"),
        F.count_if(status == "ttf_corrupt").alias("ttf_corrupt"),
    )


def mapping_stats(checked: DataFrame) -> DataFrame:
    """Mapping counts and font bytes over the assets that are fine."""
    n = F.col("mapping_count")
    return checked.filter(F.col("status") == "ok").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_mappings"),
        F.min(n).alias("min_mappings"),
        F.max(n).alias("max_mappings"),
        F.floor(F.sum(n) / F.count(F.lit(1)) + 0.5).alias("avg_mappings"),
        F.floor(F.sum(F.when(F.col("ttf_exists"), F.col("ttf_size"))) / 1024 + 0.5).alias("total_kb"),
    )


def mapping_extremes(status: DataFrame, k: int = 5) -> DataFrame:
    """The k assets with the most mappings and k assets without any, by id on ties."""
    top = status.orderBy(F.desc("mapping_count"), "asset_id").limit(k)
    none = status.filter(F.col("mapping_count") == 0).orderBy("asset_id").limit(k)
    return top.select(F.lit("top").alias("kind"), "asset_id", "mapping_count").unionByName(
        none.select(F.lit("bottom").alias("kind"), "asset_id", "mapping_count")
    )


def final_invariants(entries: DataFrame, with_geo: DataFrame) -> DataFrame:
    """Counts that must all be zero once every conflict is resolved."""
    final = with_geo.filter(F.col("skip").isNull()).select(
        "glyph_hash",
        F.col("final_code").alias("code"),
        F.col("final_hex").alias("code_hex"),
        F.col("final_name").alias("name"),
        F.lit(0).cast("long").alias("ord_major"),
    )

    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    lost = entries.join(with_geo.select("glyph_hash"), "glyph_hash", "left_anti")
    return side_by_side(
        n(code_conflicts(final), "shared_codes"),
        n(name_conflicts(final), "shared_names"),
        n(lost, "unaccounted_entries"),
    )
