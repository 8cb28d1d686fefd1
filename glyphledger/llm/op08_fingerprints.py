"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of paragraphs.

Leaves are short runs of words that end where their content says so, hence an
edit changes the leaves it touches and no others. A paragraph hashes its leaves,
a section its paragraphs, the root its sections. Equal roots mean equal texts;
where roots differ, equal branches are passed over and the rest locates the edit.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

# A leaf ends at the end of a sentence or line, after a word whose checksum is 0 modulo
# _LEAF_STEP, and after _LEAF_WORDS words at the latest.
_WORD = re.compile(r"\s*\S*[ \t]*\n?")
_LEAF_STEP = 8
_LEAF_WORDS = 16
_SECTION_STEP = 8  # a section ends after a paragraph whose hash is 0 modulo this
_NODE = 16  # bytes of a node


def _digest(kind: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=_NODE, person=kind).digest()


def _leaves(paragraph: str) -> list[str]:
    """Cut one paragraph into leaves; they join to the paragraph again."""
    out, start, words = [], 0, 0
    for found in _WORD.finditer(paragraph):
        word = found[0].strip()
        words += 1
        if word and (word[-1] in ".!?" or words == _LEAF_WORDS or zlib.crc32(word.encode()) % _LEAF_STEP == 0):
            out.append(paragraph[start : found.end()])
            start, words = found.end(), 0
    if start < len(paragraph):
        out.append(paragraph[start:])
    return out


class Tree:
    """Merkle tree of a text: sections of paragraphs of (hash, first character, length) leaves."""

    def __init__(self, text: str) -> None:
        self.n_chars = len(text)
        self.sections: list[tuple[bytes, list[tuple[bytes, list[tuple[bytes, int, int]]]]]] = []
        at, open_section = 0, []
        for paragraph in text.splitlines(keepends=True):
            leaves = []
            for leaf in _leaves(paragraph):
                leaves.append((_digest(b"leaf", leaf.encode()), at, len(leaf)))
                at += len(leaf)
            node = _digest(b"paragraph", b"".join(x[0] for x in leaves))
            open_section.append((node, leaves))
            if node[0] % _SECTION_STEP == 0:
                self._close(open_section)
                open_section = []
        if open_section:
            self._close(open_section)
        self.root = _digest(b"root", b"".join(s[0] for s in self.sections))

    def _close(self, paragraphs: list) -> None:
        self.sections.append((_digest(b"section", b"".join(p[0] for p in paragraphs)), paragraphs))

    def differing(self, other: Tree) -> list[tuple[int, int]]:
        """Character spans of this text's leaves that the other tree lacks, merged where they touch."""
        if self.root == other.root:
            return []
        sections = {s[0] for s in other.sections}
        paragraphs = {p[0] for s in other.sections for p in s[1]}
        leaves = {x[0] for s in other.sections for p in s[1] for x in p[1]}
        spans: list[tuple[int, int]] = []
        for node, inner in self.sections:
            if node in sections:
                continue
            for mark, own in inner:
                if mark in paragraphs:
                    continue
                for leaf, at, n in own:
                    if leaf in leaves:
                        continue
                    if spans and spans[-1][1] == at:
                        spans[-1] = (spans[-1][0], at + n)
                    else:
                        spans.append((at, at + n))
        return spans

    def counted(self) -> Counter:
        """Characters under each leaf hash."""
        out: Counter = Counter()
        for _, inner in self.sections:
            for _, own in inner:
                for leaf, _, n in own:
                    out[leaf] += n
        return out


def likeness(a: Tree, b: Tree) -> float:
    """Share of both texts' characters that lie under leaves they have in common; 1 for equal roots."""
    if a.root == b.root:
        return 1.0
    x, y = a.counted(), b.counted()
    if len(x) > len(y):
        x, y = y, x
    shared = sum(min(n, y[k]) for k, n in x.items() if k in y)
    return 2 * shared / max(1, a.n_chars + b.n_chars)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the next one (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "key long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(key: int | None, text: str, tree: Tree, following: str, next_tree: Tree) -> tuple:
    changed = edited(text, following)
    changed_tree = tree if changed == text else Tree(changed)
    return (
        key,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        tree.root.hex(),
        changed_tree.root.hex(),
        likeness(tree, changed_tree),
        likeness(tree, next_tree),
    )


def fingerprint_neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprint every text, its edited form and its likeness to the next text by key.

    Texts are dealt out in blocks of neighbouring keys by one exchange; the first
    text of a block also goes to the block before it (the very first to the last),
    so a block has every next text it needs. Null texts are empty; null keys come
    first; rows of equal key follow each other by text. A lone row follows itself.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark = docs.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    at = F.coalesce("key", F.lit(least))
    # Bounds, first keys and their blocks are bounded by the number of blocks.
    found = rows.select(at.alias("at")).agg(
        F.percentile_approx("at", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("b")
    ).first()["b"]
    bounds = np.array(sorted(set(found or [])), np.int64)

    @pandas_udf(LongType())
    def block_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy()))

    dealt = rows.withColumn("block", block_of(at))
    heads = {
        r["block"]: r["least"]
        for r in rows.select(at.alias("at")).groupBy(block_of(F.col("at")).alias("block")).agg(F.min("at").alias("least")).collect()
    }
    ring = sorted(heads)
    # First key of a block -> the block before it, around the ring.
    before = {heads[b]: ring[i - 1] for i, b in enumerate(ring)}

    @pandas_udf(LongType())
    def block_before(keys: pd.Series) -> pd.Series:
        return keys.map(before).astype("Int64")

    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("tail"))
    tail = F.struct(F.col("before").alias("block"), F.lit(1).alias("tail"))
    sent = (
        dealt.withColumn("before", block_before(at))
        .withColumn("to", F.explode(F.when(F.col("before").isNotNull(), F.array(own, tail)).otherwise(F.array(own))))
        .select("key", "text", F.col("to.block").alias("block"), F.col("to.tail").alias("tail"))
        .repartition("block")
        .sortWithinPartitions("block", "tail", F.col("key").asc_nulls_first(), "text")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in COLUMNS.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        last: tuple | None = None  # (block, key, text, tree) that waits for its next text
        for batch in batches:
            found = []
            for name, value, block, tail in zip(
                *(batch.column(c).to_pylist() for c in ("key", "text", "block", "tail")), strict=True
            ):
                if last is None or last[0] != block:
                    last = None
                    if tail:
                        continue
                    last = (block, name, value, Tree(value))
                    continue
                tree = last[3] if value == last[2] else Tree(value)
                found.append(_compare(last[1], last[2], last[3], value, tree))
                # Of several equal head keys the least text comes first and is the next one.
                last = None if tail else (block, name, value, tree)
            if found:
                cols = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return sent.mapInArrow(walk, COLUMNS).withColumnRenamed("key", key)
