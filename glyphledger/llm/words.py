"""Words of whole texts as 64-bit numbers, for whole Arrow batches at once.

A word is a run of bytes outside 20 and 09-0D (ASCII white space), so words never
depend on how a batch was cut. Null texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RANDOM = np.random.default_rng(0x5EED)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWER = np.full(1 << 16, _STEP)
_POWER[0] = 1
_POWER = np.multiply.accumulate(_POWER)
# An independent factor for each place in a word: no arrangement of letters clashes by construction.
_PLACE = _RANDOM.integers(0, 2**64, 1 << 16, dtype=np.uint64) | np.uint64(1)
_CHUNK = 1 << 20


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts have about ``limit`` bytes, so scratch arrays stay small."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, batch.num_rows), strict=True):
        if lo < hi:
            yield batch.slice(int(lo), int(hi - lo))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text begins (one place more than texts)."""
    texts = column.to_pylist()
    parts = [b"" if t is None else t.encode() if isinstance(t, str) else t for t in texts]
    places = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=places[1:])
    return np.frombuffer(b"".join(parts), np.uint8), places


def word_hashes(data: np.ndarray, places: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text begin among them.

    Works on pieces of about a megabyte cut at white space, so scratch memory does
    not grow with a text. A word of more bytes than there are places is named by a
    digest of its bytes.
    """
    cuts = np.zeros(len(data) + 1, bool)
    cuts[places[:-1]] = True
    hashes, starts = [], []
    lo = 0
    while lo < len(data):
        hi = min(lo + _CHUNK, len(data))
        while hi < len(data) and not (cuts[hi] or SPACES[data[hi]]):
            near = np.flatnonzero(SPACES[data[hi : hi + 4096]] | cuts[hi : min(hi + 4096, len(data))])
            hi = hi + int(near[0]) if len(near) else min(hi + 4096, len(data))
        piece = data[lo:hi]
        gap = SPACES[piece]
        first = ~gap
        first[1:] &= gap[:-1] | cuts[lo + 1 : hi]
        at = np.flatnonzero(first)
        if len(at):
            piece, gap = piece[at[0] :], gap[at[0] :]
            rel = at - at[0]
            inside = np.arange(len(piece)) - np.repeat(rel, np.diff(np.append(rel, len(piece))))
            letters = _LOWER[piece] if lower else piece
            value = _BYTE[letters] * _PLACE[inside & 0xFFFF]
            value[gap] = 0
            own = mix(np.add.reduceat(value, rel))
            size = np.add.reduceat(~gap, rel, dtype=np.int64)
            for long in np.flatnonzero(size > len(_PLACE)):
                word = letters[rel[long] : rel[long] + size[long]].tobytes()
                own[long] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            hashes.append(own)
            starts.append(at + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(places), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), places)


def roll(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbours, by doubling."""
    out, have, power = None, 0, h
    size = 1
    while True:
        if n & size:
            if out is None:
                out, have = power, size
            else:
                m = max(0, len(power) - have)
                out = out[:m] + power[have : have + m] * _POWER[have]
                have += size
                m = max(0, len(h) - have + 1)
                out = out[:m]
        size *= 2
        if size > n:
            return mix(out[: max(0, len(h) - n + 1)])
        m = max(0, len(power) - size // 2)
        power = power[:m] + power[size // 2 : size // 2 + m] * _POWER[size // 2]


def slide(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """Least (``np.minimum``) or largest of every run of ``n`` neighbours, by doubling."""
    if len(values) < n:
        return values[:0]
    size = 1
    while size * 2 <= n:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = n - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values
