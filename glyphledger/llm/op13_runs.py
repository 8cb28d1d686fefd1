"""Periodic runs of words in whole texts, by internal pattern matching.

A run is a stretch whose words repeat with a period at least three times. For
each power of two, blocks of that many words are laid over the text; the blocks
of a run come back one period later, in a neighbouring window. Where a block
stands in the suffix array is known from the doubling that built it; its
occurrences in a window are a range successor query to a wavelet tree over that
array. Three or more occurrences in one window are a progression, which leaves at
most two periods to try. Every candidate is extended with longest common
extensions, so the result is exact.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.llm.columns import spark_schema
from glyphledger.llm.words import roll, slices, text_bytes, word_hashes

LEAST = 24  # words of the shortest run
TIMES = 3  # periods that a run holds at least
ECHO = 16  # words of a run that stand again one period later, whatever the period
_LONG, _TEXT = pa.int64(), pa.string()
RUN = pa.struct([("start", _LONG), ("length", _LONG), ("period", _LONG)])

Runs = list[tuple[int, int, int]]


class SuffixArray:
    """Positions in the order of what follows them, refined by doubling up to blocks of 2**top words.

    ``rank[k]`` names the block of 2**k words at each position by the first place
    it has in the array. A block cut off by the end equals no other.
    """

    def __init__(self, words: np.ndarray, top: int) -> None:
        n = len(words)
        self.n = n
        self.order = np.argsort(words, kind="stable")
        first = np.concatenate([[True], words[self.order][1:] != words[self.order][:-1]]) if n else np.zeros(0, bool)
        rank = np.empty(n, np.int32)
        rank[self.order] = self._heads(first)
        self.rank = [rank]
        for k in range(top):
            rank = rank.copy()
            # Only positions that share their block with another one can still move.
            at = np.flatnonzero(self.shared(k))
            ahead = at + (1 << k)
            later = np.where(ahead < n, self.rank[k][np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
            key = self.rank[k][at].astype(np.int64) * (n + 1) + later
            turn = np.argsort(key, kind="stable")
            at, key = at[turn], key[turn]
            old = self.rank[k][at]
            starts = self._heads(np.concatenate([[True], old[1:] != old[:-1]])) if len(at) else old
            slot = old + (np.arange(len(at)) - starts)
            self.order[slot] = at
            heads = self._heads(np.concatenate([[True], key[1:] != key[:-1]])) if len(at) else old
            rank[at] = slot[heads]
            self.rank.append(rank)

    @staticmethod
    def _heads(first: np.ndarray) -> np.ndarray:
        """For each place, the last place up to it that is marked."""
        return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))

    def shared(self, k: int) -> np.ndarray:
        """Whether the block of 2**k words at each position stands elsewhere too."""
        return np.bincount(self.rank[k], minlength=self.n)[self.rank[k]] > 1

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on."""
        return self._extend(i, j, 1)

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j."""
        return self._extend(i, j, -1)

    def _extend(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            live, size, rank = np.arange(len(i)), 1 << k, self.rank[k]
            while len(live):
                a, b = i[live] + way * got[live], j[live] + way * got[live]
                if way < 0:
                    a, b = a - size, b - size
                fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) + size <= self.n)
                live, a, b = live[fits], a[fits], b[fits]
                live = live[rank[a] == rank[b]]
                got[live] += size
                # Below the largest block one more can follow at most.
                if k < len(self.rank) - 1:
                    break
        return got


class WaveletTree:
    """Counts and ranked values of any range of a number sequence, one level for each bit."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros, self.left = [], []
        for shift in range(self.bits - 1, -1, -1):
            low = (values >> shift & 1) == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.left.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[low], values[~low]])

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers in places lo..hi (end exclusive) are less than ``value``."""
        found = np.zeros(len(lo), np.int64)
        for level, (before, zeros) in enumerate(zip(self.left, self.zeros, strict=True)):
            up = (value >> (self.bits - 1 - level) & 1) == 1
            a, b = before[lo], before[hi]
            found += np.where(up, b - a, 0)
            lo, hi = np.where(up, zeros + lo - a, a), np.where(up, zeros + hi - b, b)
        return found

    def ranked(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth least number (from 0) in places lo..hi; range successor together with ``below``."""
        found = np.zeros(len(lo), np.int64)
        for level, (before, zeros) in enumerate(zip(self.left, self.zeros, strict=True)):
            a, b = before[lo], before[hi]
            up = nth >= b - a
            nth = np.where(up, nth - (b - a), nth)
            found |= up.astype(np.int64) << (self.bits - 1 - level)
            lo, hi = np.where(up, zeros + lo - a, a), np.where(up, zeros + hi - b, b)
        return found


def _stride(k: int) -> int:
    """Distance of the blocks of 2**k words.

    A run of a period in 2**k .. 2**(k+1) - 1 has room for a block, and its copy
    one period later, at ``max(LEAST, TIMES * period) - period - 2**k + 1`` places
    in a row or more.
    """
    room = min(max(LEAST, TIMES * q) - q - (1 << k) + 1 for q in (1 << k, (2 << k) - 1, min(max(1 << k, LEAST // TIMES), (2 << k) - 1)))
    return 1 << (room.bit_length() - 1)


def find_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a word number sequence, by start and then period."""
    n = len(words)
    none = np.zeros((0, 3), np.int64)
    if n < LEAST:
        return none
    top = max(0, (n // TIMES).bit_length() - 1)
    suffixes = SuffixArray(words, top)
    tree = WaveletTree(suffixes.order)
    at, period = [], []
    for k in range(top + 1):
        size = 1 << k
        i = np.arange(0, n - size + 1, _stride(k))
        lo = suffixes.rank[k][i].astype(np.int64)
        hi = lo + np.bincount(suffixes.rank[k], minlength=n)[lo]
        again = hi - lo > 1
        i, lo, hi = i[again], lo[again], hi[again]
        # Occurrences that begin between one and two block lengths on.
        skip = tree.below(lo, hi, np.minimum(i + size, n))
        count = tree.below(lo, hi, np.minimum(i + 2 * size, n)) - skip
        some = count > 0
        i, lo, hi, skip, count = i[some], lo[some], hi[some], skip[some], count[some]
        one = tree.ranked(lo, hi, skip)
        more = count > 1
        two = one.copy()
        two[more] = tree.ranked(lo[more], hi[more], skip[more] + 1)
        few, pair = count < 3, count == 2
        at += [i[few], i[pair]]
        period += [one[few] - i[few], two[pair] - i[pair]]
        many = ~few
        if many.any():
            # The block has the step of the progression as its period. A longer period must carry
            # an end of the stretch around the block to the same end of the stretch around its copies.
            i, one = i[many], one[many]
            step = two[many] - one
            right = one + suffixes.ahead(one, one + step) - i - suffixes.ahead(i, i + step)
            left = one - suffixes.behind(one, one + step) - i + suffixes.behind(i, i + step)
            for q in (right, left):
                good = (q >= size) & (q < 2 * size) & (i + q < n)
                at.append(i[good])
                period.append(q[good])
    i, q = np.concatenate(at), np.concatenate(period)
    if not len(i):
        return none
    back = suffixes.behind(i, i + q)
    length = back + suffixes.ahead(i, i + q) + q
    start = i - back
    good = length >= np.maximum(LEAST, TIMES * q)
    runs = np.unique(np.stack([start[good], length[good], q[good]], axis=1), axis=0)
    # Multiples of a period have the same stretch; rows are sorted, so the least period comes first.
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


Arrange = Callable[[int | None, int], np.ndarray | None]


def planted(key: int | None, n: int) -> np.ndarray | None:
    """Word order of the contract's planted repeats: a tenth of the keys repeat a stretch up to their end.

    None leaves a text as it is; a null key does too.
    """
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def runs_of_texts(texts: list[bytes], orders: list[np.ndarray | None]) -> list[np.ndarray]:
    """Runs of each text, its words taken in the given order.

    A text without any stretch of ``ECHO`` words that stands twice has no run: the
    words of a run but its last period come again one period later. The others
    are searched together, with word numbers of their own each.
    """
    data, places = text_bytes(pa.array(texts, pa.binary()))
    h, at = word_hashes(data, places)
    for t, order in enumerate(orders):
        if order is not None:
            h[at[t] : at[t + 1]] = h[at[t] : at[t + 1]][order]
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    if len(h) < ECHO:
        return out
    text_of = np.repeat(np.arange(len(texts)), np.diff(at))
    inside = text_of[: len(h) - ECHO + 1] == text_of[ECHO - 1 :]
    marks, owner = roll(h, ECHO)[inside], text_of[: len(h) - ECHO + 1][inside]
    turn = np.lexsort((marks, owner))
    marks, owner = marks[turn], owner[turn]
    wanted = np.unique(owner[1:][(marks[1:] == marks[:-1]) & (owner[1:] == owner[:-1])])
    if not len(wanted):
        return out
    numbers, starts, used = [], [0], 0
    for t in wanted:
        # Hashes may clash; these numbers do not.
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in texts[t].split()], np.int64) + used
        used += len(number)
        numbers.append(ids if orders[t] is None else ids[orders[t]])
        starts.append(starts[-1] + len(ids))
    found = find_runs(np.concatenate(numbers))
    cuts = np.searchsorted(found[:, 0], starts)
    for nth, t in enumerate(wanted):
        part = found[cuts[nth] : cuts[nth + 1]].copy()
        part[:, 0] -= starts[nth]
        out[t] = part
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs.tolist():
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most repetitions, compared exactly; ties go to the least start, then period."""

    def compare(a: tuple, b: tuple) -> int:
        x, y = b[1] * a[2], a[1] * b[2]
        return (x > y) - (x < y) or (a[0] > b[0]) - (a[0] < b[0]) or (a[2] > b[2]) - (a[2] < b[2])

    return min(map(tuple, runs.tolist()), key=cmp_to_key(compare), default=None)


def _over_texts(docs: DataFrame, text: str, key: str, schema: pa.Schema, row: Callable, arrange: Arrange) -> DataFrame:
    """One result row for each row of ``docs``: ``row(key, text, words, order, runs)``, in runs of texts of 4 MB."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            keys = batch.column("key").to_pylist()
            values = batch.column("text").to_pylist()
            texts = [(t or "").encode() for t in values]
            split = [t.split() for t in texts]
            orders = [arrange(k, len(w)) for k, w in zip(keys, split, strict=True)]
            found = runs_of_texts(texts, orders)
            rows = [row(*x) for x in zip(keys, values, split, orders, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(schema.types)], schema=schema
            )

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(scan, spark_schema(schema)).withColumnRenamed("key", key)


def _as_it_is(key: int | None, n: int) -> None:
    return None


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, runs) of every row; ``runs`` are structs (start, length, period) by start, then period.

    Null and empty texts have no words and no runs. Repeated rows and null keys
    are rows like any other; other columns are not read. Work and memory follow
    the length of a text times its logarithm.
    """

    def row(k: int | None, value: str | None, words: list[bytes], order: np.ndarray | None, runs: np.ndarray) -> tuple:
        return k, len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]

    return _over_texts(docs, text, key, pa.schema([("key", _LONG), ("n_words", _LONG), ("runs", pa.list_(RUN))]), row, _as_it_is)


def collapse_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text): every run cut to its first period, words joined by one space.

    A text without runs stays byte for byte, and null stays null.
    """

    def row(k: int | None, value: str | None, words: list[bytes], order: np.ndarray | None, runs: np.ndarray) -> tuple:
        if not len(runs):
            return k, value
        keep = kept_words(len(words), runs)
        return k, b" ".join(w for w, stay in zip(words, keep.tolist(), strict=True) if stay).decode()

    return _over_texts(docs, text, key, pa.schema([("key", _LONG), ("text", _TEXT)]), row, _as_it_is).withColumnRenamed("text", text)


DIGEST = pa.schema(
    [(c, _LONG) for c in ("key", "n_runs", "start", "length", "period", "exponent_milli")]
    + [("runs_sha256", _TEXT), ("collapsed_sha256", _TEXT)]
)


def run_digests(docs: DataFrame, text: str = "text", key: str = "doc_id", arrange: Arrange = planted) -> DataFrame:
    """(key, n_runs, strongest run, digests) of every row, after the words are arranged by the contract.

    Without a run start, length, period and exponent_milli are null; digests never are.
    """

    def row(k: int | None, value: str | None, words: list[bytes], order: np.ndarray | None, runs: np.ndarray) -> tuple:
        if order is not None:
            words = [words[i] for i in order.tolist()]
        if len(runs):
            keep = kept_words(len(words), runs).tolist()
            words = [w for w, stay in zip(words, keep, strict=True) if stay]
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        best = strongest(runs)
        return (
            k,
            len(runs),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest(),
        )

    return _over_texts(docs, text, key, DIGEST, row, arrange)
