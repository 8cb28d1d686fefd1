"""Alignment of two tokenizers' tokens over the same bytes, on Arrow arrays throughout.

Ids of a run of texts are flattened with their parent rows; token lengths summed
up give end offsets, and an end joined with its document is one key. A hash join
of both sides on these keys finds the places where both end, and a full one the
links: every stretch between neighbouring ends lies in one token of each side.
Id pairs are counted for each run with ``group_by``; Spark adds the partial counts
and hands every run the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.llm.columns import spark_schema
from glyphledger.llm.words import slices
from glyphledger.session import materialize

RUN = 2 << 20  # bytes of text aligned together; a longer text is a run of its own
ROOM = 2 << 20  # characters of parts whose ids a worker keeps
MARK = "▁"
JOINED = 1 << 16  # characters of new parts encoded as one text
_BORDER = re.compile(rf"^[\s{MARK}]|[\s{MARK}]$")
_LONE_SPACE = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")


def byte_letters() -> dict[str, int]:
    """Byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer: ids of texts as a list array, and the bytes behind each id.

    Texts come cut before lone spaces, where no token of either kind spans the cut,
    and the ids of parts are kept: words come again and again. Two generations of
    about ``ROOM`` characters are held.
    """

    surface: pa.Array  # bytes of an id, by id
    whole = False  # a token may hold a space inside: texts are not cut

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def finish(self, table: list[bytes]) -> None:
        self.surface = pa.array(table, pa.binary())
        self.length = pc.binary_length(self.surface).cast(pa.int64())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, parts: set[str]) -> None:
        if self.size > ROOM:
            self.known, self.older, self.size = {}, self.known, 0
        wanted = parts - self.known.keys()
        old = wanted & self.older.keys()
        self.known.update({p: self.older[p] for p in old})
        new = wanted - old
        # Parts that neither begin nor end with a space are encoded joined, as they stand in texts.
        plain = [p for p in new if p and not _BORDER.search(p)]
        self._learn_joined(plain)
        rest = list(new - self.known.keys())
        self.known.update((p, np.asarray(x, "<i4").tobytes()) for p, x in zip(rest, self.ids_of(rest), strict=True))
        self.size += sum(map(len, wanted))

    def _learn_joined(self, parts: list[str]) -> None:
        """Ids of many parts from texts made of them; a text whose tokens have other bytes is left out."""
        size = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) // JOINED
        groups = np.split(np.arange(len(parts)), np.flatnonzero(np.diff(size)) + 1) if parts else []
        texts = [[parts[i] for i in g] for g in groups]
        for some, found in zip(texts, self.ids_of([" ".join(t) for t in texts]), strict=True):
            ids = np.asarray(found, "<i4")
            ends = np.cumsum(self.length.take(pa.array(ids)).to_numpy())
            stops = np.cumsum([len(p.encode()) + 1 for p in some])
            at = np.searchsorted(ends, stops)
            if len(ends) and ends[-1] == stops[-1] and (ends[np.minimum(at, len(ends) - 1)] == stops).all():
                raw, cuts = ids.tobytes(), [0, *((at + 1) * 4).tolist()]
                self.known.update((p, raw[lo:hi]) for p, lo, hi in zip(some, cuts, cuts[1:], strict=False))

    def encode(self, cut: list[list[str]]) -> pa.ListArray:
        """Ids of texts given as their parts."""
        if self.whole:
            cut = [[" ".join(parts)] for parts in cut]
        self._learn(set().union(*cut))
        found = [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
        ends = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in found], out=ends[1:])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))


class ByteLevel(Side):
    """A byte-level BPE of the tokenizers library, over space + text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            table[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
            # Word pieces start with their space; one with a space after a word would span a cut.
            self.whole = self.whole or re.search(r"\S ", table[i].decode(errors="ignore")) is not None
        self.finish(table)

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([f" {p}" for p in parts], add_special_tokens=False)
        return [e.ids for e in found]


class Pieces(Side):
    """A SentencePiece model; it puts the space in front itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        table = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            table.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode())
            self.whole = self.whole or MARK in piece.lstrip(MARK)
        self.finish(table)

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        return self.model.encode(parts, num_threads=1)


_SIDES: dict[tuple[type, str], Side] = {}


def side(kind: type, path: str) -> Side:
    """The tokenizer of a file, built once in a worker."""
    if (kind, path) not in _SIDES:
        _SIDES[kind, path] = kind(path)
    return _SIDES[kind, path]


def _agree(ids: pa.ListArray, side: Side, wanted: pa.Array) -> pa.Array:
    """Whether the joined bytes of each row's tokens are the wanted ones."""
    pieces = pa.ListArray.from_arrays(ids.offsets, side.surface.take(pc.list_flatten(ids)))
    return pc.equal(pc.binary_join(pieces, pa.scalar(b"")), wanted)


@dataclass
class Tokens:
    """Flattened tokens of one side: id, row and end offset over all rows, which is a key of row and place."""

    ids: pa.Array
    rows: pa.Array
    ends: pa.Array

    @classmethod
    def of(cls, ids: pa.ListArray, side: Side) -> Tokens:
        flat = pc.list_flatten(ids)
        # Both sides cover the same bytes, so the running sum over all rows needs no restart to match.
        return cls(flat, pc.list_parent_indices(ids), pc.cumulative_sum(side.length.take(flat)))


@dataclass
class Aligned:
    """Rows of one run: the ids of both sides, where groups end among them, and the links in order."""

    a: pa.ListArray
    b: pa.ListArray
    cut_a: np.ndarray  # for each group, the place after its last token on this side
    cut_b: np.ndarray
    group_rows: np.ndarray
    link_rows: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(texts: pa.Array, left: Side, right: Side) -> Aligned:
    """Align the tokens of whole texts; rows without tokens on both sides or with other bytes have none."""
    values = texts.to_pylist()
    wanted = pa.array([f" {t}".encode() if t else None for t in values], pa.binary())
    cut = [_LONE_SPACE.split(t or "") for t in values]
    a, b = left.encode(cut), right.encode(cut)
    fine = pc.fill_null(pc.and_(_agree(a, left, wanted), _agree(b, right, wanted)), False)
    empty = pa.scalar([], a.type)
    a, b = pc.if_else(fine, a, empty), pc.if_else(fine, b, empty)
    x, y = Tokens.of(a, left), Tokens.of(b, right)
    place = lambda t: pa.array(np.arange(len(t.ids)))
    ends_a = pa.table({"end": x.ends, "a": place(x)})
    ends_b = pa.table({"end": y.ends, "b": place(y)})
    # Ends rise strictly, so a place follows from the order of the ends alone.
    both = ends_a.join(ends_b, "end", join_type="full outer", use_threads=False).sort_by("end")
    at_a, at_b = both["a"].combine_chunks(), both["b"].combine_chunks()
    shared = pc.and_(at_a.is_valid(), at_b.is_valid()).to_numpy(zero_copy_only=False)
    # The token over a stretch is the next one to end; the last end of a row is on both sides.
    next_a = pc.fill_null_backward(at_a).to_numpy()
    next_b = pc.fill_null_backward(at_b).to_numpy()
    rows = x.rows.to_numpy()
    return Aligned(
        a,
        b,
        next_a[shared] + 1,
        next_b[shared] + 1,
        rows[next_a[shared]],
        rows[next_a],
        x.ids.to_numpy()[next_a],
        y.ids.to_numpy()[next_b],
    )


def _decimal(size: int) -> pa.Array:
    return pa.array(np.arange(size)).cast(pa.string())


def group_texts(found: Aligned, names_a: pa.Array, names_b: pa.Array) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each row; rows without tokens have an empty text."""

    def joined(ids: pa.ListArray, cuts: np.ndarray, names: pa.Array) -> pa.Array:
        ends = pa.array(np.concatenate([[0], cuts]).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(ends, names.take(pc.list_flatten(ids))), ",")

    groups = pc.binary_join_element_wise(
        joined(found.a, found.cut_a, names_a), joined(found.b, found.cut_b, names_b), "|"
    )
    ends = np.searchsorted(found.group_rows, np.arange(len(found.a) + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), groups), ";")


def _pack(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers with their counts, as compressed steps."""
    steps = np.diff(numbers, prepend=0).astype("<u4")
    return pa.compress(steps.tobytes() + times.astype("<u4").tobytes(), "zstd", asbytes=True)


def _unpack(blob: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, 8 * size, "zstd", asbytes=True), "<u4")
    return np.cumsum(raw[:size], dtype=np.int64), raw[size:].astype(np.int64)


_IDS = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
_COUNTS = [(c, pa.int64()) for c in ("key", "n_a", "n_b", "n_groups", "n_links")]
ROWS = pa.schema(
    [
        ("run", pa.int64()),
        *_COUNTS,
        ("groups_sha256", pa.string()),
        ("n_pairs", pa.int32()),
        ("pairs", pa.binary()),
        ("ids", pa.list_(_IDS)),
    ]
)
RESULT = pa.schema([*_COUNTS, ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
GROUPS = pa.schema(
    [("key", pa.int64()), ("groups", pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))]
)


def _aligned_rows(path_a: str, path_b: str):
    """A row for each text, its pairs numbered within the run, and a row with the ids and counts of these numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        left, right = side(ByteLevel, path_a), side(Pieces, path_b)
        names_a, names_b = _decimal(len(left.surface)), _decimal(len(right.surface))
        run = TaskContext.get().partitionId() << 32
        for batch in (part for whole in batches for part in slices(whole, limit=RUN)):
            run += 1
            found = align(batch.column("text"), left, right)
            n = batch.num_rows
            links = pa.table({"row": found.link_rows, "a": found.link_a, "b": found.link_b})
            held = links.group_by(["row", "a", "b"], use_threads=False).aggregate([([], "count_all")])
            counted = held.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
            order = np.lexsort((counted["b"].to_numpy(), counted["a"].to_numpy()))
            counted = counted.take(order)
            name = lambda t: t["a"].to_numpy().astype(np.int64) << 32 | t["b"].to_numpy()
            number = np.searchsorted(name(counted), name(held))
            row, times = held["row"].to_numpy(), held["count_all"].to_numpy()
            turn = np.lexsort((number, row))
            row, number, times = row[turn], number[turn], times[turn]
            cuts = np.searchsorted(row, np.arange(n + 1))
            sizes = np.diff(cuts)
            texts = group_texts(found, names_a, names_b).to_pylist()
            per_row = lambda rows: np.bincount(rows, minlength=n)
            blank = [None]
            ids = [{"a": a, "b": b, "n": c} for a, b, c in zip(*(counted[k].to_pylist() for k in ("a", "b", "count_all")), strict=True)]
            columns = {
                "run": [run] * (n + 1),
                "key": batch.column("key").to_pylist() + blank,
                "n_a": pc.list_value_length(found.a).to_pylist() + blank,
                "n_b": pc.list_value_length(found.b).to_pylist() + blank,
                "n_groups": per_row(found.group_rows).tolist() + blank,
                "n_links": per_row(found.link_rows).tolist() + blank,
                "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts] + blank,
                "n_pairs": sizes.tolist() + blank,
                "pairs": [_pack(number[lo:hi], times[lo:hi]) if lo < hi else b"" for lo, hi in zip(cuts, cuts[1:], strict=False)] + blank,
                "ids": blank * n + [ids],
            }
            yield pa.RecordBatch.from_pydict(columns, ROWS)

    return scan


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Texts of one run with the sums over their links of the corpus-wide counts."""
    size = max(counts.num_rows, 1)
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = counts["number"].to_numpy()
    count[at], best[at] = counts["count"].to_numpy(), counts["best"].to_numpy()
    n_best, total = [], []
    for blob, n in zip(rows["pairs"].to_pylist(), rows["n_pairs"].to_pylist(), strict=True):
        number, times = _unpack(blob, n) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        n_best.append(int(best[number] @ times))
        total.append(int(count[number] @ times))
    kept = rows.select(["key", "n_a", "n_b", "n_groups", "n_links"])
    out = kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
    return out.append_column("groups_sha256", rows["groups_sha256"]).cast(RESULT)


def pair_counts(ids: DataFrame) -> DataFrame:
    """(a, b, count, best) from partial counts ``n``: documents that hold the pair, and whether no pair of ``a`` has more."""
    total = ids.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = total.groupBy("a").agg(F.max("count").alias("most"))
    return total.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def link_report(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and texts whose tokens do not join to space + text on
    both sides, have no tokens: zeros and an empty digest column. Repeated rows and
    null keys are rows like any other and each counts as a document of its pairs.
    Other columns are not read. A run of texts has ``RUN`` bytes or is one text, so
    the pairs that meet in one group are bounded by that.
    """
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    every = materialize(slim.mapInArrow(_aligned_rows(path_a, path_b), spark_schema(ROWS)))
    ids = every.filter("ids is not null").select("run", F.posexplode("ids").alias("number", "id")).select("run", "number", "id.*")
    counts = materialize(pair_counts(ids))
    own = ids.select("run", "number", "a", "b").join(counts, ["a", "b"]).select(F.col("run").alias("of_run"), "number", "count", "best")
    rows = every.filter("ids is null").drop("ids")
    return (
        rows.groupBy("run").cogroup(own.groupBy("of_run")).applyInArrow(_scored, spark_schema(RESULT)).withColumnRenamed("key", key)
    )


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, groups) of every row; a group is a struct of the ids of both sides over the same bytes, in order."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = side(ByteLevel, path_a), side(Pieces, path_b)
        for batch in (part for whole in batches for part in slices(whole, limit=RUN)):
            found = align(batch.column("text"), left, right)
            lists = []
            for ids, cuts in ((found.a, found.cut_a), (found.b, found.cut_b)):
                ends = pa.array(np.concatenate([[0], cuts]).astype(np.int32))
                lists.append(pa.ListArray.from_arrays(ends, pc.list_flatten(ids)))
            rows = np.searchsorted(found.group_rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            groups = pa.ListArray.from_arrays(pa.array(rows), pa.StructArray.from_arrays(lists, ["a", "b"]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), groups.cast(GROUPS.field(1).type)], schema=GROUPS)

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(scan, spark_schema(GROUPS)).withColumnRenamed("key", key)
