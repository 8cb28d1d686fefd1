"""Sequential codes from a fixed range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.codes import PRIVATE_HI, PRIVATE_LO, code_to_hex
from glyphledger.operators.ordering import number_rows


def allocate(
    requests: DataFrame,
    order: list[str],
    used: DataFrame | None = None,
    lo: int = PRIVATE_LO,
    hi: int = PRIVATE_HI,
    out: str = "new_code",
) -> DataFrame:
    """Give each request the next free code in ``order``; fail when the range runs out.

    Requests and free codes are numbered by range sorts, in many tasks, and joined
    on the number. The numbered requests are written, so their count is known before
    anything is returned: more of them than free codes is an error whatever
    columns are read later.
    """
    codes = requests.sparkSession.range(lo, hi + 1).select(F.col("id").alias("_code"))
    if used is not None:
        taken = used.filter(F.col("code").between(lo, hi)).select(F.col("code").cast("long").alias("_code")).distinct()
        codes = codes.join(taken, "_code", "left_anti")
    free = number_rows(codes, ["_code"], "_rank")
    ranked = number_rows(requests, order, "_rank")
    if ranked.count() > free.count():
        raise ValueError(f"code range exhausted at U+{hi + 1:04X}")
    return ranked.join(free, "_rank").withColumn(out, F.col("_code").cast("int")).drop("_rank", "_code")


def allocation_log(allocated: DataFrame) -> DataFrame:
    return allocated.select(
        "glyph_hash",
        F.concat(F.lit("U+"), code_to_hex(F.col("new_code"))).alias("pua"),
        "reason",
    )
