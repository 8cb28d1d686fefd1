"""Best-fit decreasing packing of token pieces into sequences of a fixed size.

Best-fit decreasing looks at lengths only, and there are at most ``SIZE`` of
them. So the driver sees how many pieces each length has, packs whole runs of
equal pieces into whole runs of equal bins with a segment tree over the remaining
capacities, and gets a plan whose size depends on ``SIZE`` alone. Tasks then find
the place of each piece from its number among the pieces of its length. The
result is the one that packing piece by piece would give.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphledger.session import materialize

SIZE = 2048
END = 0  # the id that ends every document
CACHE = 600_000  # pieces of words whose ids a worker keeps
_CACHES: dict[str, WordIds] = {}

# How the tokenizer cuts lower-cased text, written for what ``_PLAIN`` admits.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[ \t-\r!-~À-ÖØ-öø-ÿ]*")


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next unused."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return "".join(chr(b) if b in prints else chr(next(spare)) for b in range(256))


class Kept(dict):
    """A bounded dictionary of what was used lately: two halves, the older one dropped when the newer is full."""

    def __init__(self, room: int, make) -> None:
        super().__init__()
        self.half, self.make, self.old = max(1, room // 2), make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Ids of whole texts from a tokenizer that drops white space and never joins across it.

    Ids of the pieces that the tokenizer cuts words into are kept, so its merges run
    once for a piece while that is kept. Words with anything but ASCII and Latin-1
    letters, and words that could hold a special token, go through the whole
    tokenizer.
    """

    def __init__(self, path: str, room: int = CACHE) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.pieces = Kept(room, self._piece)

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))

    def ids(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids of a text, in order."""
        whole = text.decode()
        if "<|" not in whole and _PLAIN.fullmatch(whole):
            return self._plain(whole)
        out = []
        for word in text.split():
            word = word.decode()
            if "<|" not in word and _PLAIN.fullmatch(word):
                out.append(self._plain(word))
            else:
                out.append(np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes())
        return b"".join(out)


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker process; kept between tasks."""
    if path not in _CACHES:
        _CACHES[path] = WordIds(path)
    return _CACHES[path]


PIECES = "key long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """One row per piece: only documents over ``size`` ids are cut, into pieces of ``size``.

    ``part`` and ``nth`` number the pieces of one length inside one written
    partition. Null and empty texts are one piece with the end id alone; rows with
    a null or repeated key are packed like any other.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        source = word_ids(tokenizer)
        end = np.array([END], "<u4").tobytes()
        names = [f.split()[0] for f in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for name, value in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = source.ids((value or "").encode()) + end
                total = len(data) // 4
                for i, lo in enumerate(range(0, total, size)):
                    n = min(size, total - lo)
                    rows.append((name, i, lo, n, zlib.crc32(data[lo * 4 : (lo + n) * 4]), part, seen[n]))
                    seen[n] += 1
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    read = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return materialize(read.mapInArrow(cut, PIECES))


class _Capacities:
    """Segment tree over remaining capacities 0..size: which of them some open bin has."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.tree = [False] * (2 * self.leaves)

    def set(self, at: int, value: bool) -> None:
        at += self.leaves
        self.tree[at] = value
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] or self.tree[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest marked capacity of at least ``least``."""
        at = least + self.leaves
        if self.tree[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first, each, bin, offset) of best-fit decreasing over counted lengths.

    Pieces of ``length`` numbered from ``first`` on fill bins from ``bin`` on, with
    ``each`` pieces a bin at ``offset``. Runs of bins with equal contents are kept
    as intervals, split at most once a length, so the steps are bounded by
    ``size`` squared whatever the counts.
    """
    tree, open_bins = _Capacities(size), defaultdict(list)  # capacity -> [(first bin, bins)]
    steps, bins = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if n:
            open_bins[room].append((first, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        placed, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = size, bins, -(-left // (size // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    tree.set(room, False)
            each = room // length  # the bin just filled is the tightest until it is full
            full, over = min(n, left // each), 0
            if full:
                steps.append((length, placed, each, first, size - room))
                placed, left = placed + full * each, left - full * each
                keep(room - each * length, first, full)
            if full < n and left:
                over = left
                steps.append((length, placed, over, first + full, size - room))
                placed, left = placed + over, 0
                keep(room - over * length, first + full, 1)
            keep(room, first + full + bool(over), n - full - bool(over))
    return steps


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Give every piece its ``sequence_id`` and its ``offset`` there."""
    tally = materialize(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = np.array(plan(counts, size), np.int64).reshape(-1, 5)
    # By length and first number: the step of a piece is the last one not after it.
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    wide = 1 << 50
    begin = steps[:, 0] * wide + steps[:, 1]

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = tally.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    rows = cut.join(shifts, ["length", "part"]).withColumn("nth", F.col("nth") + F.col("shift"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            at = steps[np.searchsorted(begin, length * wide + nth, "right") - 1]
            inner = nth - at[:, 1]
            keep = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(at[:, 3] + inner // at[:, 2]), pa.array(at[:, 4] + inner % at[:, 2] * length)],
                ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return rows.select("key", "piece", "start", "length", "ids_crc32", "nth").mapInArrow(
        place, "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """Cut and pack whole documents: (key, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(pieces(docs, tokenizer, text, key, size), size).withColumnRenamed("key", key)
