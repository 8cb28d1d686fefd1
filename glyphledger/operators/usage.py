"""Where icon names and stylesheets are used, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.text import WORD_EDGE, find_all, strip
from glyphledger.operators.ordering import side_by_side

# Class attributes that hold a token, quoted or templated text that holds one,
# and the two ways a line refers to a stylesheet. {tok} is the token pattern, {stem} its literal
# beginning, {kw} the stylesheet keyword.
CLASS_ATTRIBUTE = r"""(?:class|:class)\s*=\s*["'`]([^"'`]*{tok}[^"'`]*)["'`]"""
DYNAMIC_TEXT = r"""[`'"](?:[^`'"]*{stem}[^`'"]*)[`'"]|\$\{[^}]*{stem}[^}]*\}"""
STYLE_LINK = r"""(?i)<link[^>]*rel=["']stylesheet["'][^>]*href=["']([^"']*{kw}[^"']*)["'][^>]*>"""
STYLE_IMPORT = r"""(?i)@import\s+["']([^"']*{kw}[^"']*)["']"""
TOKEN_STEM = "icon-"
TOKEN_TAIL = r"[A-Za-z0-9_-]+"


def token_pattern(stem: str = TOKEN_STEM, tail: str = TOKEN_TAIL) -> str:
    return f"{WORD_EDGE}{stem}{tail}{WORD_EDGE}"


def lines(files: DataFrame) -> DataFrame:
    """One row per line, numbered from 1."""
    return files.select(
        "project",
        F.col("path").alias("file"),
        F.posexplode(F.split("content", "\n", -1)).alias("_i", "text"),
    ).select("project", "file", (F.col("_i") + 1).alias("line"), "text")


def _hits(outer: str, group: int, token: str, kind: str, auto: bool) -> Column:
    """Tokens of every outer match on a line, in order."""
    found = F.transform(
        find_all(F.col("text"), outer, group),
        lambda v: F.regexp_extract_all(v, F.lit(token), F.lit(0)),
    )
    return F.transform(
        F.flatten(found),
        lambda t: F.struct(
            t.alias("icon_name"), F.lit(kind).alias("usage_type"), F.lit(auto).alias("can_auto_replace")
        ),
    )


def _static_hits(stem: str, tail: str) -> Column:
    token = token_pattern(stem, tail)
    return _hits(CLASS_ATTRIBUTE.replace("{tok}", token), 1, token, "static_class", True)


def _dynamic_hits(stem: str, tail: str) -> Column:
    outer = DYNAMIC_TEXT.replace("{stem}", stem)
    return _hits(outer, 0, token_pattern(stem, tail), "dynamic_class", False)


def _usage_rows(lines_df: DataFrame, hits: Column) -> DataFrame:
    """A row per hit; the column is where the token first appears, so repeats share it."""
    return lines_df.select(
        "project", "file", "line", "text", F.posexplode(hits).alias("seq", "hit")
    ).select(
        "project",
        "file",
        "line",
        F.instr(F.col("text"), F.col("hit.icon_name")).alias("column"),
        strip(F.col("text")).alias("context"),
        "hit.icon_name",
        "hit.usage_type",
        "hit.can_auto_replace",
        "seq",
    )


def static_usage(lines_df: DataFrame, stem: str = TOKEN_STEM, tail: str = TOKEN_TAIL) -> DataFrame:
    """A row per token of every class attribute that holds one."""
    return _usage_rows(lines_df, _static_hits(stem, tail))


def dynamic_usage(
    lines_df: DataFrame,
    stem: str = TOKEN_STEM,
    tail: str = TOKEN_TAIL,
    exclude_static: bool = False,
) -> DataFrame:
    """Tokens inside any quoted or templated text.

    A static attribute is quoted text too and is counted again here, unless
    ``exclude_static`` takes the line's static tokens out.
    """
    hits = _dynamic_hits(stem, tail)
    if exclude_static:
        names = F.transform(_static_hits(stem, tail), lambda h: h["icon_name"])
        hits = F.filter(hits, lambda h: ~F.array_contains(names, h["icon_name"]))
    return _usage_rows(lines_df, hits)


def scan_usage(lines_df: DataFrame, stem: str = TOKEN_STEM, tail: str = TOKEN_TAIL) -> DataFrame:
    """Static and dynamic usages in one pass over the text."""
    return _usage_rows(lines_df, F.concat(_static_hits(stem, tail), _dynamic_hits(stem, tail)))


def css_refs(lines_df: DataFrame, keyword: str = "iconfont") -> DataFrame:
    """Stylesheet links and imports per line; links of a line come before its imports."""
    found = F.concat(
        find_all(F.col("text"), STYLE_LINK.replace("{kw}", keyword), 1),
        find_all(F.col("text"), STYLE_IMPORT.replace("{kw}", keyword), 1),
    )
    return lines_df.select(
        "project",
        "file",
        "line",
        strip(F.col("text")).alias("raw_html"),
        F.posexplode(found).alias("seq", "resolved_url"),
    )


def usage_index(usage: DataFrame) -> DataFrame:
    """(project, icon_name) with static, dynamic and all counts."""
    return usage.groupBy("project", "icon_name").agg(
        F.count_if(F.col("can_auto_replace")).alias("static_count"),
        F.count_if(~F.col("can_auto_replace")).alias("dynamic_count"),
        F.count(F.lit(1)).alias("usage_count"),
    )


def usage_totals(files: DataFrame, usage: DataFrame, refs: DataFrame) -> DataFrame:
    """Totals over all projects; files count only where the project has any hit."""
    hit = usage.select("project").union(refs.select("project")).distinct()
    counted = files.join(hit, "project", "left_semi").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.countDistinct("project").alias("total_projects"),
    )
    return side_by_side(counted, usage.agg(F.count(F.lit(1)).alias("total_usages")))
