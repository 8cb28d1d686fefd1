"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction; a vector passes it if their cosine exceeds ``alpha``.
Directions are all concatenations of one short random vector per block, so the
filters that a vector passes are listed from its few block products without
trying the directions one by one. Near vectors share a filter with high
probability; vectors are joined on filters and every pair is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.llm.components import components
from glyphledger.llm.op07_simhash import merge_labels
from glyphledger.llm.words import mix
from glyphledger.session import materialize

COSINE = 0.9
ALPHA = 0.5  # cosine with a filter's direction that a vector must reach
FILTERS = 32  # filters that a vector passes on average, over all codes
CODES = 4  # independent codes: a vector far from one's directions is near another's
NEAREST = 6  # a vector that passes fewer filters of a code takes that many nearest ones
BLOCKS = 4
CHUNK = 1024  # vectors of one filter that one task compares; a filter with more is split


def cap_share(dim: int, alpha: float) -> float:
    """Share of the unit sphere within ``alpha`` of a direction."""
    if dim < 3:
        return math.acos(alpha) / math.pi
    t = np.linspace(-1, 1, 200_001)
    density = (1 - t**2) ** ((dim - 3) / 2)
    return float(density[t >= alpha].sum() / density.sum())


@lru_cache(32)
def product_code(dim: int, alpha: float, filters: float, number: int) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation of the padded space, and the codebook of each block; the same in every task."""
    rng = np.random.default_rng([dim, number])
    wide = -(-dim // BLOCKS) * BLOCKS
    turn = np.linalg.qr(rng.standard_normal((wide, wide)))[0]
    # The expected number of filters is their number times the share of a cap.
    each = max(2, math.ceil((filters / max(cap_share(wide, alpha), 1e-30)) ** (1 / BLOCKS)))
    books = rng.standard_normal((BLOCKS, each, wide // BLOCKS))
    return turn, books / np.linalg.norm(books, axis=2, keepdims=True)


def _nearest(s: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best filters of one vector from its block products (best blocks combined)."""
    each, few = s.shape[1], min(s.shape[1], 4)
    best = np.argsort(-s, axis=1)[:, :few]
    total, number = np.zeros(1), np.zeros(1, np.int64)
    for b in range(BLOCKS):
        total = (total[:, None] + s[b, best[b]][None, :]).ravel()
        number = (number[:, None] * each + best[b][None, :]).ravel()
    return number[np.argsort(-total, kind="stable")[:n]]


def passed_filters(vectors: np.ndarray, alpha: float = ALPHA, filters: int = FILTERS) -> list[np.ndarray]:
    """All filters that each unit vector passes in any code, ascending (list decoding).

    Block products are added in two halves; of a half only sums that the best sum
    of the other half can complete are looked at. Where directions are sparse, the
    nearest ones stand in, so every vector has some.
    """
    n, dim = vectors.shape
    out: list[list[np.ndarray]] = [[] for _ in range(n)]
    need = alpha * math.sqrt(BLOCKS)
    for number in range(CODES):
        turn, books = product_code(dim, alpha, filters / CODES, number)
        wide, each = turn.shape[0], books.shape[1]
        padded = np.zeros((n, wide))
        padded[:, :dim] = vectors
        parts = (padded @ turn).reshape(n, BLOCKS, wide // BLOCKS)
        for own, s in zip(out, np.einsum("nbk,bek->nbe", parts, books), strict=True):
            left = (s[0][:, None] + s[1][None, :]).ravel()
            right = (s[2][:, None] + s[3][None, :]).ravel()
            a = np.flatnonzero(left >= need - right.max())
            b = np.flatnonzero(right >= need - left[a].max()) if len(a) else a
            b = b[np.argsort(-right[b])]
            size = np.searchsorted(-right[b], -(need - left[a]), "right")
            which = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found = np.repeat(a, size) * each**2 + b[which]
            if len(found) < NEAREST:
                found = np.union1d(found, _nearest(s, NEAREST))
            # A 31-bit name is enough: filters that share one only meet more candidates.
            own.append((mix((found + (number << 40)).astype(np.uint64)) >> np.uint64(33)).astype(np.int32))
    return [np.unique(np.concatenate(f)) for f in out]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, safe against very large and small parts."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coded(alpha: float, filters: int, kind: str):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None] * batch.num_rows
            vectors = [np.asarray(v, kind) for v in batch.column("v").to_pylist()]
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                for lo in range(0, len(at), 512):
                    rows = at[lo : lo + 512]
                    for i, passed in zip(rows, passed_filters(unit(np.stack([vectors[i] for i in rows])), alpha, filters), strict=True):
                        found[i] = passed
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("n"),
                    pa.array([len(v) for v in vectors], pa.int32()),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array([f.tolist() for f in found], pa.list_(pa.int32())),
                ],
                ["id", "n", "dim", "v", "filters"],
            )

    return code


def verify(ids: np.ndarray, copies: np.ndarray, side: np.ndarray, cross: bool, vectors: np.ndarray, own: int, lists: list[np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one filter: how many each vector has here, and a label that links share.

    A pair that shares several filters belongs to the smallest of them, so it is
    counted once. With ``cross`` only pairs between the two sides are looked at.
    """
    n = len(ids)
    low = [f[f < own] for f in lists]
    kinds, times = np.unique(np.concatenate(low), return_counts=True)
    kinds = kinds[times > 1]
    has = np.zeros((n, len(kinds)), np.float32)
    for i, f in enumerate(low):
        at = np.searchsorted(kinds, f)
        at = at[(at < len(kinds)) & (kinds[np.minimum(at, len(kinds) - 1)] == f)] if len(kinds) else at[:0]
        has[i, at] = 1
    v = unit(vectors)
    found, label = np.zeros(n, np.int64), np.arange(n)
    for lo in range(0, n, 256):
        hi = min(lo + 256, n)
        near = v[lo:hi] @ v.T >= cosine
        near[np.arange(hi - lo), np.arange(lo, hi)] = False
        if cross:
            near &= side[lo:hi, None] != side[None, :]
        i, j = np.nonzero(near)
        if len(i):
            merge_labels(label, i + lo, j)
            near &= has[lo:hi] @ has.T == 0
            found[lo:hi] += near @ copies
    return found, label


def _compare(cosine: float, kind: str):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: list) -> pa.RecordBatch | None:
            if len(rows) < 2:
                return None
            ids = np.array([r["id"] for r in rows], np.int64)
            order = np.argsort(ids)  # labels then name the least id
            rows, ids = [rows[i] for i in order], ids[order]
            tile = rows[0]
            found, label = verify(
                ids,
                np.array([r["n"] for r in rows], np.int64),
                np.array([r["side"] for r in rows]),
                tile["i"] != tile["j"],
                np.stack([np.frombuffer(r["v"], kind) for r in rows]),
                tile["filter"],
                [np.asarray(r["filters"], np.int32) for r in rows],
                cosine,
            )
            linked = np.flatnonzero((found > 0) | (label != np.arange(len(ids))))
            if not len(linked):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(found[linked]), pa.array(ids[label[linked]])], ["id", "links", "root"]
            )

        held: list = []
        last = None
        for batch in batches:
            for row in batch.to_pylist():
                tile = (row["dim"], row["filter"], row["i"], row["j"])
                if tile != last and held:
                    done = close(held)
                    if done is not None:
                        yield done
                    held = []
                last = tile
                held.append(row)
        done = close(held)
        if done is not None:
            yield done

    return compare


def near_vectors(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    alpha: float = ALPHA,
    filters: int = FILTERS,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Copies fold into one vector first and count as links of each other. Vectors
    that are null, empty, zero, or hold null or non-finite parts, and rows with a
    null key, link with nothing; vectors of different length never link. Rows of
    one key with different vectors are vectors of their own. Recall
    depends on ``alpha`` and ``filters`` and is measured in the tests.
    """
    number = dict(table.dtypes)[vector].removeprefix("array<").removesuffix(">")
    kind = "<f4" if number == "float" else "<f8"
    rows = table.select(
        F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("key").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # A class is a vector, whatever the keys of its rows: it gets a number of its own, fixed once written.
    counted = rows.filter(good).groupBy("v").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = materialize(counted.withColumn("id", F.monotonically_increasing_id()))
    coded = materialize(
        classes.select("v", "id", "n").mapInArrow(_coded(alpha, filters, kind), "id long, n long, dim int, v binary, filters array<int>")
    )
    each = coded.select("id", "dim", F.explode("filters").alias("filter"))
    # A filter that one vector alone passes joins nothing; one that many pass is dealt out as pairs of chunks.
    shared = each.groupBy("dim", "filter").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    places = (
        each.join(shared, ["dim", "filter"])
        .withColumn("side", F.pmod(F.xxhash64("id"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .select("id", "filter", "i", "j", "side")
    )
    tiled = places.join(coded, "id")
    dealt = tiled.select("dim", "filter", "i", "j", "side", "id", "n", "v", "filters").repartition("dim", "filter", "i", "j")
    found = materialize(
        dealt.sortWithinPartitions("dim", "filter", "i", "j").mapInArrow(
            _compare(cosine, kind), "id long, links long, root long"
        )
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found, "id", "root")
    zero = F.lit(0).cast("long")
    labelled = (
        classes.select("v", "id", "n", "least")
        .join(links, "id", "left")
        .join(named, F.col("id") == F.col("node"), "left")
        .select(
            F.col("v").alias("class_v"),
            "least",
            (F.coalesce("links", zero) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("root"),
        )
    )
    # A component is named by the least key of its vectors.
    roots = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    members = labelled.join(roots, "root").select("class_v", "n_links", "component_id")
    fine = rows.filter(good).join(members, F.col("v") == F.col("class_v")).select("key", "n_links", "component_id")
    rest = rows.filter(~good).select("key", zero.alias("n_links"), F.col("key").alias("component_id"))
    return fine.unionByName(rest).select(
        F.col("key").alias(key),
        "n_links",
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
