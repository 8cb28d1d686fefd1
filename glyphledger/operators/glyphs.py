"""Glyph rows: names, types, normalisation and its summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphledger.functions import geometry as G
from glyphledger.functions.codes import EMPTY_HASH, hex_to_code

# Usual units per em.
USUAL_UPM = (512, 1000, 1024, 2048, 4096)


def name_glyphs(glyphs: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach the icon name by (asset, code); the last rule of a code wins."""
    names = (
        rules.withColumn("code", hex_to_code(F.col("code_hex")))
        .groupBy("asset_id", "code")
        .agg(F.max_by("name", "ord").alias("icon_name"))
    )
    return glyphs.join(names, ["asset_id", "code"], "left")


def glyph_type(num_contours: Column, composite: Column) -> Column:
    return F.when(composite, "composite").when(num_contours > 0, "simple").otherwise("empty")


def glyph_type_counts(glyphs: DataFrame) -> DataFrame:
    return glyphs.groupBy("glyph_type").agg(F.count(F.lit(1)).alias("glyphs"))


def with_units(glyphs: DataFrame, units: DataFrame) -> DataFrame:
    """Units per em of each glyph's asset; 1024 where the asset gives none."""
    return glyphs.join(units.select("asset_id", "units_per_em"), "asset_id", "left").withColumn(
        "units_per_em", F.coalesce("units_per_em", F.lit(G.TARGET_UPM))
    )


def normalize_glyphs(
    glyphs: DataFrame, compat: bool = False, reorient_first: bool = False
) -> DataFrame:
    """Scale, round, fix starts, order contours and fingerprint.

    Input has glyph_type, units_per_em, contours, advance_width and lsb. The
    stored contours keep their direction; only the fingerprint uses clockwise
    forms. Starts are fixed before the direction is, so an outline and its
    reverse differ, unless ``reorient_first`` is set. Composite rows carry no
    points: they keep a null hash and an error, and other rows go on.
    """
    empty = F.col("glyph_type") == "empty"
    simple = F.col("glyph_type") == "simple"
    upm = F.col("units_per_em")
    changed = ~empty & (upm != G.TARGET_UPM)

    points = G.round_points(G.scale(F.col("contours"), upm))
    if reorient_first:
        points = F.transform(points, G.orient_cw)
    points = G.sort_contours(F.transform(points, G.rotate_start))

    def metric(name: str) -> Column:
        value = F.col(name).cast("double")
        scaled = F.when(changed, value * G.scale_factor(upm)).otherwise(value)
        return F.when(empty, value).otherwise(G.half_even(scaled))

    done = glyphs.withColumns(
        {
            "contours": F.when(empty, F.col("contours")).when(simple, points),
            "advance_width": metric("advance_width"),
            "lsb": metric("lsb"),
            "upm_changed": changed,
            "source_upm": F.when(changed, upm),
        }
    )
    return done.withColumn(
        "glyph_hash",
        F.when(empty, EMPTY_HASH).when(
            F.col("contours").isNotNull(), G.glyph_hash(F.col("contours"), compat)
        ),
    ).withColumn(
        "error", F.when(F.col("glyph_hash").isNull(), F.lit("outline has no usable points"))
    )


def norm_summary(norm: DataFrame) -> DataFrame:
    """Totals of a normalisation run; rows with an error only count as errors."""
    ok = F.col("error").isNull()
    return norm.agg(
        F.count_if(ok).alias("total"),
        F.count_if(ok & F.col("upm_changed")).alias("scaled"),
        F.count_if(ok & ~F.col("upm_changed")).alias("unchanged"),
        F.count_if(F.col("glyph_type") == "empty").alias("empty"),
        F.count_if(~ok).alias("errors"),
        F.countDistinct(F.nullif("glyph_hash", F.lit(EMPTY_HASH))).alias("distinct_hashes"),
    )


def norm_summary_by_asset(norm: DataFrame) -> DataFrame:
    """(asset_id, total, scaled), only for assets with scaled rows."""
    return (
        norm.filter(F.col("error").isNull())
        .groupBy("asset_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("upm_changed")).alias("scaled"),
        )
        .filter(F.col("scaled") > 0)
    )


def extraction_summary(glyphs: DataFrame, assets: DataFrame, units: DataFrame) -> DataFrame:
    """Per downloaded asset: glyph rows, units and whether it gave any error."""
    counts = glyphs.groupBy("asset_id").agg(F.count(F.lit(1)).alias("num_glyphs"))
    return (
        assets.filter(F.col("download_status") == "ok")
        .select("asset_id", "error")
        .join(counts, "asset_id", "left")
        .join(units, "asset_id", "left")
        .select(
            "asset_id",
            F.coalesce("num_glyphs", F.lit(0)).alias("num_glyphs"),
            "units_per_em",
            F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"),
        )
    )


def extraction_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_assets"),
        F.sum("num_glyphs").alias("total_glyphs"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "error").alias("error"),
    )


def check_units(units: DataFrame) -> DataFrame:
    """Warn about unusual units per em and about assets without glyphs."""
    bad = ~F.col("units_per_em").isin(*USUAL_UPM) | (F.col("num_glyphs") < 1)
    return units.withColumn("status", F.when(bad, "warning").otherwise("ok"))


def units_seen(units: DataFrame) -> DataFrame:
    """Distinct units per em with the number of assets."""
    return units.groupBy("units_per_em").agg(F.count(F.lit(1)).alias("assets"))
