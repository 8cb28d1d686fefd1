"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read as protobuf, and its normaliser, space marker, scores or
merges and byte fallback are rebuilt as a tokenizer. Texts are cut at places that
no piece spans, the parts go through ``encode_batch`` once while their ids are
kept, and every text's ids are compared with those of the SentencePiece library.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # stands for a space
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of piece in the format
UNIGRAM, BPE = 1, 2
CACHE = 600_000  # parts whose ids a worker keeps
RUN = 4 << 20  # characters encoded together


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    """What the format says: pieces as (text, score, kind), and the settings with their defaults."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    space_last: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    unknown_text: str = " ⁇ "

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                score = struct.unpack("<f", got[2])[0] if 2 in got else 0.0
                out.pieces.append((got.get(1, b"").decode(), score, got.get(3, NORMAL)))
            elif number == 2:
                got = dict(_fields(value))
                out.kind = got.get(3, UNIGRAM)
                out.space_last, out.byte_fallback = bool(got.get(24, 0)), bool(got.get(35, 0))
                out.unknown_text = got[44].decode() if 44 in got else out.unknown_text
            elif number == 3:
                got = dict(_fields(value))
                out.charsmap = got.get(2, b"")
                out.dummy_prefix, out.squeeze, out.escape = (bool(got.get(k, 1)) for k in (3, 4, 5))
        return out


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, the best scored first; equal scores by id."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    found = []
    for whole, i in ids.items():
        for cut in range(1, len(whole)):
            a, b = whole[:cut], whole[cut:]
            if a in ids and b in ids:
                found.append((-pieces[i][1], i, cut, a, b))
    return [(a, b) for *_, a, b in sorted(found)]


def build_tokenizer(model: Model):
    """A tokenizer of the library with the model's rules; it takes normalised text with markers."""
    from tokenizers import Tokenizer, models

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        name = model.pieces[unknown][0] if unknown is not None else None
        core = models.BPE(vocab, merges(model.pieces), unk_token=name, fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are built")
    return Tokenizer(core)


class Codec:
    """Encoder and decoder of one model in one worker process."""

    def __init__(self, path: str, room: int = CACHE) -> None:
        with open(path, "rb") as f:
            data = f.read()
        import sentencepiece
        from tokenizers import Regex, normalizers

        self.model = Model.parse(data)
        self.tokenizer = build_tokenizer(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        steps = []
        if self.model.charsmap:
            steps.append(normalizers.Precompiled(self.model.charsmap))
        if self.model.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        self.normaliser = normalizers.Sequence(steps) if steps else None
        self.room, self.known, self.older = room, {}, {}
        self.parts = re.compile(self._cuts())
        self.table = [self._surface(p, kind) for p, _, kind in self.model.pieces]
        self.bytes = {i for i, p in enumerate(self.model.pieces) if p[2] == BYTE}

    def _cuts(self) -> str:
        """Pattern of parts that no piece spans: markers with what follows them, and lone characters."""
        long = [p for p, _, kind in self.model.pieces if kind in (NORMAL, USER) and len(p) > 1]
        if self.model.space_last or any(MARK in p.lstrip(MARK) for p in long):
            return r"(?s).+"
        joined = set("".join(long))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined) if self.model.byte_fallback else ""
        lone = f"[{alone}]|" if alone else ""
        return f"{lone}{MARK}*[^{MARK}{alone}]+|{MARK}+"

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (self.model.unknown_text if kind == UNKNOWN else piece.replace(MARK, " ")).encode()

    def normalise(self, text: str) -> str:
        """The model's normal form with markers; empty stays empty."""
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        if text and self.model.dummy_prefix:
            text = text + " " if self.model.space_last else " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    def _learn(self, parts: set[str]) -> None:
        """Have the ids of all ``parts`` at hand: new ones go through the library as one batch, on its threads.

        Two generations are kept; what the newer one lacks is moved over from the older.
        """
        if len(self.known) + len(parts) > self.room // 2:
            self.known, self.older = {}, self.known
        wanted = parts - self.known.keys()
        old = wanted & self.older.keys()
        self.known.update({p: self.older[p] for p in old})
        new = list(wanted - old)
        for part, got in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
            self.known[part] = np.array(got.ids, "<u4").tobytes()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers, texts of about ``RUN`` characters at a time."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= RUN:
                size += len(texts[end])
                end += 1
            if size > RUN:
                out.append(self._encode_long(texts[at]))
            else:
                cut = [self.parts.findall(self.normalise(t)) for t in texts[at:end]]
                self._learn(set().union(*cut))
                out += [b"".join(map(self.known.__getitem__, c)) for c in cut]
            at = end
        return out

    def _encode_long(self, text: str) -> bytes:
        found = (m[0] for m in self.parts.finditer(self.normalise(text)))
        out = []
        while some := list(itertools.islice(found, self.room // 4)):
            self._learn(set(some))
            out.append(b"".join(map(self.known.__getitem__, some)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        """Text of ids; one space of the marker that normalising puts in goes again."""
        text = b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        if self.model.dummy_prefix:
            return text[:-1] if self.model.space_last and text.endswith(" ") else text[1:] if text.startswith(" ") else text
        return text


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def encode_texts(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids): ids of every whole text. Null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            found = own.encode_many([t or "" for t in batch.column("text").to_pylist()])
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.list_(pa.int32()))], ["key", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)


def decode_ids(table: DataFrame, model: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, text) of lists of ids; a null list is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [own.decode(np.asarray(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    rows = table.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "key long, text string").withColumnRenamed("key", key)


CHECKED = "key long, n_tokens long, n_byte_tokens long, ids_crc32 long, parity boolean, round_trip boolean"


def checked(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and decode every whole text and verify it.

    ``parity``: the SentencePiece library gives the same ids. ``round_trip``: the
    ids decode to the text. Null and empty texts have no ids and pass both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        kinds = np.zeros(len(own.model.pieces), bool)
        kinds[list(own.bytes)] = True
        for batch in batches:
            out = []
            values = [t or "" for t in batch.column("text").to_pylist()]
            for value, ids in zip(values, own.encode_many(values), strict=True):
                theirs = np.array(own.reference.encode(value), "<u4").tobytes()
                numbers = np.frombuffer(ids, "<u4")
                out.append((len(numbers), int(kinds[numbers].sum()), zlib.crc32(ids), ids == theirs, own.decode(ids) == value))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], _names(CHECKED)
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, CHECKED).withColumnRenamed("key", key)
