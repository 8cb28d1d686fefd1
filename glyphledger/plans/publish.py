"""From the resolution and the source lines to the published tables and the rewrite plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from glyphledger.operators import lineage as ln
from glyphledger.operators import publish as pb
from glyphledger.operators import usage as us
from glyphledger.operators.registry import Registry
from glyphledger.operators.resolution import Resolution
from glyphledger.session import materialize


def publish(res: Resolution, outlines_by_asset: DataFrame, assets: DataFrame) -> dict[str, DataFrame]:
    """Published glyphs, their stylesheet rules and their sources."""
    with_geo = materialize(pb.with_geometry(res, outlines_by_asset))
    pub = pb.publishable(with_geo)
    return {
        "glyphs": pub,
        "counts": pb.publish_counts(with_geo),
        "css": pb.css_rows(pub, res.aliases),
        "manifest": pb.merge_manifest(pub, res.sources, assets),
    }


def plan_rewrites(
    reg: Registry, res: Resolution, files: DataFrame, asset_projects: DataFrame
) -> dict[str, DataFrame]:
    """Lineage with usages, the rules per project and what they would change.

    ``plan`` lists every rule of every place and is computed only where it is used.

    The files are read for usages, for references, and, joined to the rules of the
    files that have some, for the dry run.
    """
    lines = us.lines(files)
    usage = materialize(us.scan_usage(lines))
    refs = materialize(us.css_refs(lines))
    links = ln.project_links(reg.entries, reg.sources, asset_projects)
    lineage = materialize(ln.enhance_lineage(reg.entries, links, us.usage_index(usage), refs))
    flags = materialize(ln.replacement_flags(reg.entries, reg.aliases, res.glyphs, lineage))
    made = ln.rewrite_rules(reg.entries, links, flags, usage, refs)
    rules = ln.RewriteRules(materialize(made.css), materialize(made.places), materialize(made.renames))
    return {
        "lineage": lineage,
        "flags": flags,
        "history": ln.version_history(reg.entries, flags),
        "plan": rules.listing(),
        "summary": rules.summary(),
        "diff": ln.apply_plan(files, rules),
    }
