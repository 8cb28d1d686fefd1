"""Exact positions without pulling a group, or the whole table, into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphledger.session import materialize


def number_within(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Zero-based position inside each key group, for an order that is unique in it.

    Rows are range-partitioned by key and order, sorted and written once, so a key
    that holds a third of all rows is spread over as many partitions as it fills.
    A row's position is its place among the key's rows of its partition, moved by the
    key's rows in the partitions before: one row per key and partition takes part in
    that running total, so no more for a key than there are partitions. Rows with a
    null key have no group and go.
    """
    cols = df.columns
    placed = materialize(
        df.dropna(subset=keys)
        .repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    )
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        placed.groupBy(*keys, "_p")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
        .select(*keys, "_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return placed.join(shares, [*keys, "_p"]).select(
        *cols, (F.col("_m") - F.col("_first") + F.col("_shift")).cast("long").alias(out)
    )


def number_rows(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Zero-based position in the whole table for a unique order.

    The rows are range-partitioned, sorted and written once; the written
    partition number then fixes which rows a partition holds. Only one row
    per partition takes part in the running total.
    """
    cols = df.columns
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    )
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    starts = parts.select(
        "_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # One row per partition of the range shuffle: small whatever the data.
    return placed.join(F.broadcast(starts), "_p").select(
        *cols, (F.col("_m") - F.col("_first") + F.col("_start")).cast("long").alias(out)
    )


def side_by_side(*totals: DataFrame) -> DataFrame:
    """Put one-row results next to each other: their rows are stacked and folded, not joined."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
