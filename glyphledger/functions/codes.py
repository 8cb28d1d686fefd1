"""Code points, digests and severity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity limits, their order, and the private-use range.
CRITICAL_FROM = 5
WARNING_FROM = 3
SEVERITY_ORDER = {"critical": 0, "warning": 1, "info": 2}
PRIVATE_LO = 0xE000
PRIVATE_HI = 0xF8FF
PRIVATE_NEW_HI = 0xE600

EMPTY_HASH = "empty"


def hex_to_code(h: Column) -> Column:
    return F.conv(h, 16, 10).cast("int")


def code_to_hex(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%04X", c.cast("int")))


def key_to_code(key: Column) -> Column:
    """``U+E6B5`` to its number; null for anything that is not hexadecimal."""
    body = F.regexp_replace(key, r"U\+", "")
    return F.when(body.rlike(r"\A[0-9A-Fa-f]+\z"), hex_to_code(body))


def asset_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 12)


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def severity(n: Column) -> Column:
    return (
        F.when(n >= CRITICAL_FROM, "critical").when(n >= WARNING_FROM, "warning").otherwise("info")
    )


def severity_rank(s: Column) -> Column:
    rank = F.lit(9)
    for name, value in SEVERITY_ORDER.items():
        rank = F.when(s == name, value).otherwise(rank)
    return rank
