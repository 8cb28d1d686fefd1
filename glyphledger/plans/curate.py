"""From the registry to one free of conflicts: detect, judge, decide, rewrite, resolve.

Each step ends in written tables: record ids and given codes must not change
once a later step, or a reviewer, refers to them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.codes import PRIVATE_HI, PRIVATE_LO
from glyphledger.operators import conflicts as cf
from glyphledger.operators import resolution as rs
from glyphledger.operators import rewrites as rw
from glyphledger.operators import similarity as sim
from glyphledger.operators.registry import Registry
from glyphledger.session import materialize


@dataclass(frozen=True)
class Review:
    records: DataFrame
    variants: DataFrame


# Given a review and the name of its step, the decisions in row form.
Decide = Callable[[Review, str], DataFrame]


def review(reg: Registry, outlines: DataFrame | None = None, occupancy: bool = False) -> Review:
    """Numbered conflicts, their variants and, given outlines, which are false positives."""
    records = cf.number_records(cf.all_conflicts(reg.entries))
    variants = materialize(cf.conflict_variants(reg.entries, records))
    if outlines is None:
        flagged = records.withColumn("is_false_positive", F.lit(False))
        return Review(materialize(flagged), variants)
    drawn = (
        variants.filter(F.col("type") != cf.DUPLICATE)
        .select("group_id", F.col("glyph_hash").alias("variant_id"))
        .join(outlines.select(F.col("glyph_hash").alias("variant_id"), "contours"), "variant_id")
    )
    visual = materialize(sim.occupancy_similarity(drawn)) if occupancy else None
    open_groups = sim.needs_geometry(records, visual)
    geometric = sim.min_geo_similarity(drawn.join(open_groups, "group_id", "left_semi"))
    return Review(materialize(sim.flag_false_positives(records, geometric, visual)), variants)


def _stored(reg: Registry) -> Registry:
    return Registry(materialize(reg.entries), materialize(reg.aliases), materialize(reg.sources))


def settle_names(
    reg: Registry, found: Review, decisions: DataFrame, lo: int = PRIVATE_LO, hi: int = PRIVATE_HI
) -> Registry:
    return _stored(
        rw.apply_name_resolution(reg, found.records, found.variants, decisions, lo, hi)
    )


def settle_codes(
    reg: Registry, found: Review, decisions: DataFrame, lo: int = PRIVATE_LO, hi: int = PRIVATE_HI
) -> tuple[Registry, DataFrame]:
    """The three code passes; returns the registry and the log of changes."""
    start = reg.entries
    user = materialize(
        rw.apply_code_user(start, found.records, found.variants, decisions, lo, hi)
    )
    entries = rw.with_changes(start, user)
    used = start.select("code").union(user.select("new_code"))
    auto = materialize(
        rw.apply_code_auto(entries, found.records, found.variants, decisions, used, lo, hi)
    )
    entries = materialize(rw.with_changes(entries, auto))
    updated = user.unionByName(auto)
    fresh = review(Registry(entries, reg.aliases, reg.sources))
    used = used.union(auto.select("new_code"))
    last = materialize(
        rw.apply_code_fallback(entries, fresh.records, fresh.variants, updated, used, lo, hi)
    )
    final = materialize(rw.with_changes(entries, last))
    log = rw.lineage_log(updated.unionByName(last))
    return Registry(final, reg.aliases, reg.sources), log


def curate(
    reg: Registry,
    decide: Decide,
    outlines: DataFrame | None = None,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
) -> tuple[Registry, rs.Resolution, DataFrame]:
    """Names first, then codes, then the final resolution of whatever is left."""
    first = review(reg, outlines)
    named = settle_names(reg, first, decide(first, "names"), lo, hi)
    second = review(named, outlines)
    coded, log = settle_codes(named, second, decide(second, "codes"), lo, hi)
    last = review(coded, outlines)
    final = rs.resolve(coded, last.records, last.variants, decide(last, "final"), lo, hi)
    return coded, final, log
