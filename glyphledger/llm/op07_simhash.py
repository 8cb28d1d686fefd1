"""SimHash fingerprints and their exact near-duplicate groups by tiled comparison.

Equal fingerprints are folded first, so copies never meet one another. Distinct
fingerprints are sorted by population counts and packed into tiles; a pair of
tiles is compared, with exclusive-or and bit counts, only if the population
counts of the two can lie within the radius. Each tile pair gives back a spanning
forest of its links, not the links, so large groups stay linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from glyphledger.llm.columns import fresh
from glyphledger.llm.components import components
from glyphledger.session import materialize

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 8192  # fingerprints in a tile: 64 KB
PARTS = 4  # population counts are kept for four parts of 16 bits
_ROWS = 32  # rows of a tile compared at once; bounds the scratch arrays


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned number.

    Words are split at ASCII white space after lower-casing A-Z. A text with fewer
    words than a shingle has its whole sequence as its one shingle; null and texts
    without words have fingerprint zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        n = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    left = n
    while left:
        take = min(left, 1 << 16)
        h = np.fromiter((xxhash.xxh64_intdigest(next(grams), seed) for _ in range(take)), "<u8", take)
        votes += np.unpackbits(h.view(np.uint8).reshape(take, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        left -= take
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


@pandas_udf(LongType())
def simhash_column(text: pd.Series) -> pd.Series:
    values = np.fromiter((simhash(t) for t in text), np.uint64, len(text))
    return pd.Series(values.view(np.int64))


def pack_tiles(fingerprints: DataFrame, size: int = TILE) -> DataFrame:
    """Distinct fingerprints (column ``fp``) as tiles of one population count each.

    A tile keeps the least and the largest population count of each 16-bit part.
    """
    part = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(PARTS)]
    keys = ["ones", *(f"part{i}" for i in range(PARTS)), "fp"]
    rows = fingerprints.select("fp", F.bit_count("fp").alias("ones"), *(p.alias(f"part{i}") for i, p in enumerate(part)))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "tile long, ones int, lo array<int>, hi array<int>, fps binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        made, held = 0, None

        def close(rows: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "tile": pa.array([base + made], pa.int64()),
                    "ones": pa.array([rows[0, 0]], pa.int32()),
                    "lo": pa.array([rows[:, 1 : 1 + PARTS].min(0).tolist()], pa.list_(pa.int32())),
                    "hi": pa.array([rows[:, 1 : 1 + PARTS].max(0).tolist()], pa.list_(pa.int32())),
                    "fps": pa.array([rows[:, -1].tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            new = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys], axis=1)
            held = new if held is None else np.concatenate([held, new])
            while len(held):
                end = int(np.searchsorted(held[:, 0], held[0, 0], "right"))
                if end < size and end == len(held):
                    break  # the rest of this population count may be in the next batch
                yield close(held[: min(end, size)])
                held = held[min(end, size) :]
        if held is not None and len(held):
            yield close(held)

    return materialize(placed.mapInArrow(pack, schema))


def tile_pairs(tiles: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) of the tiles whose population counts can lie within the radius, each with itself too."""
    meta = tiles.select("tile", "ones", "lo", "hi")
    left = meta.select(
        F.col("tile").alias("a"),
        F.col("ones").alias("a_ones"),
        F.col("lo").alias("a_lo"),
        F.col("hi").alias("a_hi"),
        F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)).alias("ones"),
    )
    gap = sum(
        F.greatest(F.lit(0), F.col("a_lo")[i] - F.col("hi")[i], F.col("lo")[i] - F.col("a_hi")[i])
        for i in range(PARTS)
    )
    return (
        left.join(meta, "ones")
        .filter((F.col("a_ones") < F.col("ones")) | (F.col("a") <= F.col("tile")))
        .filter(gap <= radius)
        .select("a", F.col("tile").alias("b"))
    )


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked positions; every label ends as the root of its tree."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def forest(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles (or inside one, if they are the same)."""
    same = a is b
    nodes = a if same else np.concatenate([a, b])
    label, shift = np.arange(len(nodes)), 0 if same else len(a)
    for lo in range(0, len(a), _ROWS):
        near = np.bitwise_count(a[lo : lo + _ROWS, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            merge_labels(label, i + lo, j + shift)
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def links(tiles: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): edges that connect exactly the fingerprints that links connect."""
    partner = (
        tile_pairs(tiles, radius)
        .join(tiles.select(F.col("tile").alias("a"), "fps"), "a")
        .select("b", F.when(F.col("a") != F.col("b"), F.col("a")).otherwise(-1).alias("a"), "fps")
    )
    # A tile's own row (a = -1) comes first and stays while its partners stream by.
    work = partner.repartition("b").sortWithinPartitions("b", "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            u, v = [], []
            for b, a, blob in zip(*(batch.column(c).to_pylist() for c in ("b", "a", "fps")), strict=True):
                fps = np.frombuffer(blob, np.int64)
                if a == -1:
                    own = (b, fps)
                x, y = forest(own[1], own[1] if a == -1 else fps, radius)
                u.append(x)
                v.append(y)
            if u:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"]
                )

    return work.mapInArrow(compare, "u long, v long")


def _roots(fingerprints: DataFrame, radius: int) -> DataFrame:
    """(fp, root) of distinct fingerprints: the least one reachable over links."""
    distinct = fingerprints.select("fp").distinct()
    found = components(links(pack_tiles(distinct), radius))
    return distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", F.coalesce("component", "fp").alias("root"))


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id): the least key whose fingerprint is reachable over links.

    Repeated rows stay; rows with a null key get the component of their fingerprint
    but never name it, and a component of null keys only is null. Other columns
    are not read.
    """
    marked = materialize(docs.select(F.col(key).alias("key"), simhash_column(F.col(text)).alias("fp")))
    least = marked.groupBy("fp").agg(F.min("key").alias("least"))
    labelled = least.join(_roots(marked, radius), "fp")
    roots = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of = labelled.join(roots, "root").select("fp", "component_id")
    return marked.join(of, "fp").select(F.col("key").alias(key), "fp", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row of each near-duplicate group, all columns kept: that with the least key, then text digest.

    Rows count, not keys: rows of one key with unlike texts are in groups of their
    own and each is judged there. Of rows that agree in key and text, one stays: the
    one whose other columns hash least. Rows with a null key link others but cannot
    be told apart and all stay.
    """
    names = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    digest, rest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.xxhash64(*[F.col(c) for c in names])
    rank = F.struct(F.col("key"), F.col("digest"), F.col("rest"))
    marked = materialize(
        docs.select(
            F.col(key).alias("key"),
            digest.alias("digest"),
            rest.alias("rest"),
            simhash_column(F.col(text)).alias("fp"),
        )
    )
    first = marked.filter("key is not null").groupBy("fp").agg(F.min(rank).alias("first"))
    chosen = first.join(_roots(marked, radius), "fp").groupBy("root").agg(F.min("first").alias("first"))
    own_digest, own_rest, k, d, r = fresh(docs, "own_digest", "own_rest", "k", "d", "r")
    keep = chosen.select(F.col("first.key").alias(k), F.col("first.digest").alias(d), F.col("first.rest").alias(r))
    rows = docs.filter(F.col(key).isNotNull()).withColumns({own_digest: digest, own_rest: rest})
    same = (rows[key] == F.col(k)) & (F.col(own_digest) == F.col(d)) & (F.col(own_rest) == F.col(r))
    stay = rows.join(keep, same, "left_semi")
    one = stay.dropDuplicates([key, own_digest, own_rest]).drop(own_digest, own_rest)
    return one.unionByName(docs.filter(F.col(key).isNull()))
