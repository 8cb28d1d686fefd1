"""Record tables: explicit schemas in, sorted or per-project files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def load_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a table of records with a given schema; parquet if the path says so, else JSON.

    A JSON file may hold one array of records or one record per line. An array is
    one task per file, so it suits tables of many small files; large tables should
    have a record per line.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).option("multiLine", _is_array(path)).json(path)


def _is_array(path: str) -> bool:
    return not path.rstrip("/").endswith(".jsonl")


def write_records(
    df: DataFrame, path: str, order: list[Column | str], meta: DataFrame | None = None
) -> None:
    """Write sorted records, and beside them the one-row totals of the run.

    The sort is a range shuffle, so the files follow the order.
    """
    _write(df.orderBy(*order), path)
    if meta is not None:
        stem, dot, kind = path.rstrip("/").rpartition(".")
        _write(meta, f"{stem}.meta{dot}{kind}" if dot else f"{path}.meta")


def _write(df: DataFrame, path: str) -> None:
    out = df.write.mode("errorifexists")
    if path.rstrip("/").endswith(".parquet"):
        out.parquet(path)
    else:
        out.json(path)


def write_by_project(df: DataFrame, path: str) -> None:
    """One folder per project.

    The rebalance hint gathers small projects into few files and lets the
    runtime split a project that is too large for one task.
    """
    out = df.hint("rebalance", "project")
    out.write.mode("errorifexists").partitionBy("project").parquet(path)


def registry_current(base: DataFrame, resolved: DataFrame | None) -> DataFrame:
    """The resolved registry where there is one, else the base registry."""
    return base if resolved is None else resolved
