"""From a tree of source files and a glyph table to the registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.operators import links, registry
from glyphledger.operators.glyphs import name_glyphs, normalize_glyphs, with_units
from glyphledger.session import materialize
from glyphledger.sources.files import wanted_file


def _no_paths(hits: DataFrame) -> DataFrame:
    """No project has paths: placeholders stay, and the rest of their lines is read all the same."""
    none = F.lit(None).cast("string")
    return hits.limit(0).select("project", none.alias("public_path"), none.alias("assets_path"))


@dataclass(frozen=True)
class LinkTables:
    found: DataFrame  # project, path, url
    index: DataFrame  # url, project


def collect_links(
    all_files: DataFrame,
    patterns: Sequence[str],
    seeds: DataFrame,
    paths: DataFrame | None = None,
    keyword: str = links.KEYWORD,
    aliases: Mapping[str, str] | None = None,
) -> LinkTables:
    """Every link of every project, one spelling per dedup key, and who uses it.

    The text of the scanned files is read once, that of the local stylesheets they
    name once more. Comments are stripped first; template placeholders are filled
    in the lines that hold one.
    """
    wanted = all_files.filter(wanted_file(F.col("path")))
    hits = materialize(links.scan_links(wanted, patterns, keyword))
    if paths is not None:
        filled = links.fill_links(hits, paths, patterns, keyword)
    else:
        filled = links.fill_links(hits, _no_paths(hits), patterns, keyword)
    followed = links.follow_targets(links.local_targets(hits), wanted, all_files, patterns, keyword, aliases)
    found = materialize(links.hit_links(filled, keyword, aliases).unionByName(followed).distinct())
    ordered = found.select("project", "url", F.struct("project", "path").alias("ord"))
    index = links.add_seeds(links.link_index(ordered), seeds, aliases)
    return LinkTables(found, index)


def build_from_glyphs(raw: DataFrame, rules: DataFrame, units: DataFrame) -> registry.Registry:
    """Name, scale, fingerprint and group raw glyph rows; rows with an error are left out."""
    named = name_glyphs(with_units(raw, units), rules)
    normal = normalize_glyphs(named).filter(F.col("error").isNull())
    return registry.build_registry(normal)
