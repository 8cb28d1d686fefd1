"""Stylesheets: font files they load and the icon rules they define."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.text import find_all, resolve_url, strip

# url(...) of a font file, rule blocks, the content code, the three name forms.
FONT_URL = r"""(?i)url\s*\(\s*["']?([^"')\s]+\.(ttf|woff2?)(?:\?[^"')\s]*)?)\s*["']?\)"""
RULE_BLOCK = r"([^{}]+?)\{([^}]*)\}"
CONTENT_CODE = r"""content\s*:\s*["']?\\([0-9a-fA-F]+)["']?\s*(?:[;}]|\z)"""
NAME_FORMS = (
    (r"\A\.icon-([a-zA-Z0-9_-]+)(?::\w+)?\z", "icon-"),
    (r"\A\.icon([A-Z][a-zA-Z0-9_-]*)(?::\w+)?\z", "icon"),
    (r"\A\.s-([a-zA-Z0-9_-]+)(?::\w+)?\z", "s-"),
)
FORMAT_ORDER = ("ttf", "woff2", "woff")


def font_url(sheets: DataFrame) -> DataFrame:
    """Add font_url, font_format and status to (asset_id, css_url, css); null css = not found."""
    # The pattern is matched once; the parts are cut from each match.
    calls = F.transform(
        find_all(F.col("css"), FONT_URL, 0),
        lambda m: F.struct(
            F.regexp_extract(m, FONT_URL, 1).alias("url"),
            F.lower(F.regexp_extract(m, FONT_URL, 2)).alias("fmt"),
        ),
    )

    def first(fmt: str) -> Column:
        return F.get(F.filter(F.col("_calls"), lambda u: u["fmt"] == fmt), F.lit(0))["url"]

    firsts = [(fmt, first(fmt)) for fmt in FORMAT_ORDER]
    chosen = F.coalesce(*[u for _, u in firsts])
    fmt = F.coalesce(*[F.when(u.isNotNull(), F.lit(f)) for f, u in firsts])
    return (
        sheets.withColumn("_calls", calls)
        .withColumn("_url", chosen)
        .withColumn("font_format", F.coalesce(fmt, F.lit("ttf")))
        .withColumn("font_url", F.when(F.col("_url").isNotNull(), resolve_url(F.col("_url"), F.col("css_url"))))
        .withColumn(
            "status",
            F.when(F.col("css").isNull(), "css_404")
            .when(F.col("font_url").isNull(), "no_ttf_url")
            .otherwise("found"),
        )
        .drop("_calls", "_url")
    )


def selector_name(selector: Column) -> Column:
    """The icon name of one selector; null for any other selector."""
    s = strip(selector)
    return F.coalesce(
        *[
            F.when(s.rlike(p), F.concat(F.lit(prefix), F.regexp_extract(s, p, 1)))
            for p, prefix in NAME_FORMS
        ]
    )


def css_rules(sheets: DataFrame) -> DataFrame:
    """(asset_id, ord, name, code_hex, selector) of every icon rule, in text order."""
    blocks = sheets.select(
        "asset_id", F.posexplode(find_all(F.col("css"), RULE_BLOCK, 0)).alias("block_no", "block")
    )
    parts = blocks.select(
        "asset_id",
        "block_no",
        F.regexp_extract("block", RULE_BLOCK, 1).alias("sel"),
        F.lower(
            F.regexp_extract(strip(F.regexp_extract("block", RULE_BLOCK, 2)), CONTENT_CODE, 1)
        ).alias("code_hex"),
    ).filter(F.col("code_hex") != "")
    named = parts.select(
        "asset_id", "block_no", "code_hex", F.posexplode(F.split("sel", ",", -1)).alias("sel_no", "s")
    ).withColumn("name", selector_name(F.col("s")))
    return named.filter(F.col("name").isNotNull()).select(
        "asset_id",
        F.struct("block_no", "sel_no").alias("ord"),
        "name",
        "code_hex",
        F.concat(F.lit("."), F.col("name"), F.lit(":before")).alias("selector"),
    )


def mapping_status(assets: DataFrame, sheets: DataFrame, rules: DataFrame) -> DataFrame:
    """(asset_id, mapping_count, extract_status); assets without a stylesheet are left out."""
    counts = rules.groupBy("asset_id").agg(F.count(F.lit(1)).alias("mapping_count"))
    readable = sheets.filter(F.col("css").isNotNull()).select(
        "asset_id", F.lit(True).alias("readable")
    )
    return (
        assets.filter(F.col("download_status") != "css_404")
        .select("asset_id")
        .join(readable, "asset_id", "left")
        .join(counts, "asset_id", "left")
        .select(
            "asset_id",
            F.coalesce("mapping_count", F.lit(0)).alias("mapping_count"),
            F.when(F.col("readable").isNull(), "parse_error")
            .when(F.col("mapping_count").isNull(), "no_icons")
            .otherwise("ok")
            .alias("extract_status"),
        )
    )
