"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

N-grams are hashed and counted over all training texts. A count is quantised to
a level on a log scale, and the filter holds the pairs (n-gram, 1) to (n-gram,
level). A reader probes level after level until one is missing, and takes the
count of the last level found; errors are one-sided and fall off with each
level. The filter grows with its entries, so the share of false probes does not.
It is cut into buckets by hash and filled bucket by bucket. While the whole is small
it is broadcast; a larger one stays in its buckets, and the distinct n-grams of each
run of texts go there and come back as levels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.llm.words import mix, slices, text_bytes, word_hashes
from glyphledger.session import materialize

ORDER = 2  # longest n-gram
BASE = 2.0  # a level covers counts up to this factor apart
LEVELS = 64  # highest level, that of the largest 64-bit count; a reader stops at the first level missing
PROBES = 3  # bits of one (n-gram, level)
BITS_EACH = 6  # bits of the filter for one entry, whatever the corpus
LARGEST_BITS = 1 << 29  # a filter up to this size, 64 MB, is broadcast; a larger one is probed by buckets
SHARE = 0.7  # weight of the bigram estimate in the mixture
BUCKETS = 1024  # parts of the filter; an n-gram's leading hash bits name its part
HEAD_WORDS = 1 << 20  # most frequent words whose exact counts are broadcast; the others are joined
END = np.uint64(0x0E0D0F0E0D0F0E0D)  # stands for the end of a text; also its beginning as context
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HELD = 1 << 27  # bytes of unpacked buckets that a filling task holds
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, ends included, and the first of each text (one place more)."""
    words, at = word_hashes(*text_bytes(texts), lower=True)
    out = np.insert(words, at[1:], END)
    return out, at + np.arange(len(at))


def grams(token: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each token; before a text stands its end token."""
    h = token.copy()
    before = token
    for _ in range(order - 1):
        before = np.concatenate([[END], before[:-1]])
        before[at[:-1]] = END
        h = mix(h * _STEP + before)
    return h


def quantise(counts: np.ndarray) -> np.ndarray:
    """Level of a count: 1 for 1, one more for every factor ``BASE``."""
    return np.minimum(1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9), LEVELS).astype(np.int64)


# Middle of a level on the log scale; level 0 is a count of 0.
COUNT_OF = np.concatenate([[0.0, 1.0], BASE ** (np.arange(1, LEVELS) + 0.5) * 1.0])


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(54)).astype(np.int64)


def _bits(h: np.ndarray, level: int, width: int) -> Iterator[np.ndarray]:
    """Places of one (n-gram, level) inside its bucket of ``width`` bits."""
    x = mix(h ^ (_LEVEL * np.full(1, level, np.uint64)))
    step = (x >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((x + np.uint64(i) * step) % np.uint64(width)).astype(np.int64)


def levels_of(bits: np.ndarray, h: np.ndarray, width: int, base: np.ndarray) -> np.ndarray:
    """Levels of n-grams whose buckets begin at ``base``: goes up until one is missing."""
    level = np.zeros(len(h), np.uint8)
    alive = np.arange(len(h))
    for j in range(1, LEVELS + 1):
        if not len(alive):
            break
        found = np.ones(len(alive), bool)
        for place in _bits(h[alive], j, width):
            at = base[alive] + place
            found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[found]
        level[alive] = j
    return level


def probe(bits: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    """Estimated counts from a whole filter."""
    return COUNT_OF[levels_of(bits, h, width, bucket_of(h) * width)]


def trained(key: str = "doc_id", folds: int = 7, held: int = 2) -> F.Column:
    """Rows that the model learns from; a null key hashes as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds != held


def count_grams(docs: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """(n, h, c): counts of all n-grams of ``docs`` up to ``order``, folded in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(order)]
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for n, parts in enumerate(held, 1):
                h, c = np.unique(np.concatenate(parts), return_counts=True)
                for lo in range(0, len(h), 1 << 18):
                    cut = slice(lo, lo + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h[cut]), n, np.int32)), pa.array(h[cut].view(np.int64)), pa.array(c[cut])],
                        ["n", "h", "c"],
                    )

        for batch in (part for whole in batches for part in slices(whole)):
            token, at = tokens(batch.column("text"))
            for n in range(1, order + 1):
                held[n - 1].append(grams(token, at, n))
            size += len(token)
            if size > 1 << 21:
                yield from out()
                held, size = [[] for _ in range(order)], 0
        if size:
            yield from out()

    rows = docs.select(F.col(text).alias("text"))
    # One exchange by bucket serves the sums, and leaves few buckets in a written file.
    dealt = rows.mapInArrow(count, "n int, h long, c long").withColumn(
        "bucket", F.shiftrightunsigned("h", 54).cast("int")
    )
    return materialize(dealt.repartition("bucket").groupBy("bucket", "n", "h").agg(F.sum("c").alias("c")))


def filter_width(counts: DataFrame) -> int:
    """Bits of a bucket: ``BITS_EACH`` for each entry."""
    level = F.least(F.floor(F.log(BASE, F.col("c")) + 1e-9) + 1, F.lit(LEVELS))
    entries = counts.agg(F.sum(level)).first()[0] or 0
    return max(64, entries * BITS_EACH // BUCKETS // 8 * 8)


def filter_parts(counts: DataFrame, width: int) -> DataFrame:
    """(bucket, bits): the filter of all counted n-grams; a bucket is the union of its rows."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for bucket, bits in parts.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int32()),
                        pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                    ],
                    ["bucket", "bits"],
                )

        for batch in batches:
            h, c = batch.column("h").to_numpy().view(np.uint64), batch.column("c").to_numpy()
            order = np.argsort(bucket_of(h), kind="stable")
            h, top = h[order], quantise(c[order])
            owner = bucket_of(h)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(h)), strict=True):
                if lo == hi:
                    continue
                if int(owner[lo]) not in parts and (len(parts) + 1) * width > _HELD:
                    yield from out()
                    parts.clear()
                bits = parts.setdefault(int(owner[lo]), np.zeros(width, bool))
                for j in range(1, int(top[lo:hi].max()) + 1):
                    for at in _bits(h[lo:hi][top[lo:hi] >= j], j, width):
                        bits[at] = True
        yield from out()

    return counts.select("h", "c").mapInArrow(fill, "bucket int, bits binary")


def build_filter(counts: DataFrame, width: int | None = None) -> tuple[bytes, int]:
    """The whole filter on the driver, and the width of a bucket in bits; for filters up to ``LARGEST_BITS``."""
    width = width or filter_width(counts)
    whole = np.zeros(BUCKETS * width // 8, np.uint8)
    # A bucket lies in few files, so this is the filter and little more.
    for row in filter_parts(counts, width).collect():
        at = row["bucket"] * width // 8
        whole[at : at + width // 8] |= np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes(), width


RUNS = "run long, keys array<long>, held array<boolean>, texts array<string>"


def text_runs(rows: DataFrame) -> DataFrame:
    """One row for every run of texts of about 4 MB, written once: its number names the same texts ever after."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 36
        for batch in (part for whole in batches for part in slices(whole)):
            ends = pa.array([0, batch.num_rows], pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.concat_arrays([batch.column(c)])) for c in ("key", "held_out", "text")
            ]
            yield pa.RecordBatch.from_arrays([pa.array([run]), *lists], ["run", "keys", "held", "texts"])
            run += 1

    return materialize(rows.mapInArrow(gather, RUNS))


def asked(texts: pa.Array) -> np.ndarray:
    """Distinct n-grams of a run of texts, sorted, hence in the order of their buckets."""
    token, at = tokens(texts)
    return np.unique(np.concatenate([token, grams(token, at, 2)]))


def run_levels(runs: DataFrame, parts: DataFrame, width: int) -> DataFrame:
    """(run, found): the levels of the n-grams that each run asks for, as one piece per bucket.

    N-grams are dealt by bucket. A task holds one bucket of the filter at a time:
    its parts come first in the sort, then what the runs ask of it.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                h = asked(batch.column("texts").slice(i, 1).flatten())
                ends = np.searchsorted(bucket_of(h), np.arange(BUCKETS + 1))
                some = np.flatnonzero(np.diff(ends))
                offsets = np.append(ends[some], len(h)).astype(np.int32) * 8
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array(np.full(len(some), batch.column("run")[i].as_py())),
                        pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(h)]),
                    ],
                    ["bucket", "run", "data"],
                )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bits = -1, np.zeros(0, np.uint8)
        for batch in batches:
            bucket, run = batch.column("bucket").to_numpy(), batch.column("run").to_numpy()
            data = batch.column("data")
            cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(run < 0) != 0)) + 1
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(run)), strict=True):
                if lo == hi:
                    continue
                if bucket[lo] != held:
                    held, bits = int(bucket[lo]), np.zeros(width // 8, np.uint8)
                if run[lo] < 0:
                    for i in range(lo, hi):
                        bits |= np.frombuffer(data[i].as_buffer(), np.uint8)
                    continue
                size = pc.binary_length(data.slice(lo, hi - lo)).to_numpy() // 8
                h = np.frombuffer(b"".join(data.slice(lo, hi - lo).to_pylist()), np.uint64)
                level = levels_of(bits, h, width, np.zeros(len(h), np.int64))
                offsets = np.append(0, np.cumsum(size)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run[lo:hi]),
                        pa.array(bucket[lo:hi]),
                        pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(level)]),
                    ],
                    ["run", "bucket", "level"],
                )

    dealt = parts.select("bucket", F.lit(-1).cast("long").alias("run"), F.col("bits").alias("data")).unionByName(
        runs.select("run", "texts").mapInArrow(ask, "bucket int, run long, data binary")
    )
    seen = dealt.repartition("bucket").sortWithinPartitions("bucket", "run").mapInArrow(look, "run long, bucket int, level binary")
    return seen.groupBy("run").agg(F.collect_list(F.struct("bucket", "level")).alias("found"))


def _head(words: DataFrame) -> DataFrame:
    """The most frequent words, at most ``HEAD_WORDS``: those from some power of two on."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r["level"]: r["n"] for r in words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = 64, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > HEAD_WORDS:
            break
        least = at
    return words.filter(F.col("c") >= float(2**least))


FIELDS = (
    "row long, key long, held_out boolean, n_tokens long, head_known long, head_log double, "
    "score double, rare array<struct<h: long, times: long>>"
)


def score_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", share: float = SHARE) -> DataFrame:
    """Base and model scores of every whole text; learns from the rows outside the held-out fold.

    The base score uses exact counts: those of the most frequent words come with
    a broadcast of fixed size, those of all others by a join on the word. The
    model mixes the bigram estimate with the add-one unigram one, both from filter
    counts, which are the same whether the filter is broadcast or probed by buckets;
    an unseen context leaves its share to the unigram. Null and empty
    texts are one end token. Rows with null or repeated keys are scored like any
    other; without training rows every token is unknown.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    counts = count_grams(rows.filter(trained("key")))
    words = counts.filter("n = 1").select("h", "c")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    width = filter_width(counts)
    small = BUCKETS * width <= LARGEST_BITS
    filtered = sc.broadcast(build_filter(counts, width)[0]) if small else None
    table = _head(words).toArrow()
    h = table["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    head = sc.broadcast((h[order], table["c"].to_numpy()[order]))
    norm = math.log10(n + v + 1)
    del table, h, order

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Callable]]:
        bits = np.frombuffer(filtered.value, np.uint8)
        for batch in (part for every in batches for part in slices(every)):
            yield batch, lambda h: probe(bits, h, width)

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Callable]]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = [batch.column(c).slice(i, 1).flatten() for c in ("keys", "held", "texts")]
                kinds = asked(one[2])
                pieces = sorted((f["bucket"], f["level"]) for f in batch.column("found")[i].as_py())
                count = COUNT_OF[np.frombuffer(b"".join(p for _, p in pieces), np.uint8)]
                yield (
                    pa.RecordBatch.from_arrays(one, ["key", "held_out", "text"]),
                    lambda h, kinds=kinds, count=count: count[np.searchsorted(kinds, h)],
                )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known_words, known_counts = head.value
        row = TaskContext.get().partitionId() << 36
        for batch, estimate in (whole if small else by_bucket)(batches):
            token, at = tokens(batch.column("text"))
            kinds, which = np.unique(token, return_inverse=True)
            seen = estimate(kinds)
            # The context of a first token is the end token, whose count is that of all texts.
            context = np.concatenate([which[-1:], which[:-1]])
            context[at[:-1]] = np.searchsorted(kinds, END)
            pair, where = np.unique(grams(token, at, 2), return_inverse=True)
            both = estimate(pair)[where]
            del pair, where
            uni = (seen[which] + 1) / (n + v + 1)
            ctx = np.maximum(seen[context], both)
            mixed = np.where(ctx > 0, share * both / np.maximum(ctx, 1) + (1 - share) * uni, uni)
            place = np.searchsorted(known_words, kinds)
            place[place == len(known_words)] = 0
            hit = known_words[place] == kinds if len(known_words) else np.zeros(len(kinds), bool)
            c = np.where(hit, known_counts[place], 0) if len(known_words) else np.zeros(len(kinds), np.int64)
            # Words outside the head, counted once a text.
            odd = np.flatnonzero(~hit[which])
            of = np.searchsorted(at, odd, "right") - 1
            code, times = np.unique(of * len(kinds) + which[odd], return_counts=True)
            splits = np.searchsorted(code // len(kinds), np.arange(len(at)))
            rare = pa.ListArray.from_arrays(
                pa.array(splits, pa.int32()),
                pa.StructArray.from_arrays([pa.array(kinds[code % len(kinds)].view(np.int64)), pa.array(times)], ["h", "times"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)),
                    batch.column("key"),
                    batch.column("held_out"),
                    pa.array(np.diff(at)),
                    pa.array(np.add.reduceat(hit[which].astype(np.int64), at[:-1])),
                    pa.array(np.add.reduceat(np.log10(c + 1.0)[which], at[:-1])),
                    pa.array(np.add.reduceat(np.log10(mixed), at[:-1])),
                    rare,
                ],
                [f.split()[0] for f in ("row", "key", "held_out", "n_tokens", "head_known", "head_log", "score", "rare")],
            )
            row += batch.num_rows

    texts = rows.select("key", "text", (~trained("key")).alias("held_out"))
    if not small:
        runs = text_runs(texts)
        texts = runs.join(run_levels(runs, filter_parts(counts, width), width), "run")
    scored = materialize(texts.mapInArrow(score, FIELDS))
    odd = scored.select("row", F.explode("rare").alias("r")).select("row", "r.h", "r.times")
    rest = (
        odd.join(words, "h")
        .groupBy("row")
        .agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("log"))
    )
    zero = F.lit(0)
    return scored.drop("rare").join(rest, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
