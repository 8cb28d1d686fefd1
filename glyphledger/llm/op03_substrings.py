"""Exact removal of repeated word passages, decided by suffix automata of reference shards.

One automaton of the whole corpus fits nowhere, and streaming every document
through every shard is quadratic. So the windows of all texts are first routed:
a window goes by its anchor, the least hash among its runs of ``GRAM`` words,
which equal windows share. Windows in a row with the same anchor travel together
as a passage. An anchor met once needs no more work, and a passage alone under its
anchor repeats as a whole if it was met twice. The distinct passages of the other
anchors are dealt to shards; a task builds the suffix automaton of its shard with
occurrence counts and streams the passages through it for matching statistics:
where the longest match ending at a word reaches the window length and the matched
state was met twice, the window repeats.

A shard is bounded: the passages of an anchor with more words than that are routed
again by a second anchor over longer runs of words, and so on up to runs as long
as a window, where equal windows alone are left together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from glyphledger.llm.columns import fresh
from glyphledger.llm.words import SPACES, roll, slices, slide, text_bytes, word_hashes
from glyphledger.session import materialize

RANGES = "ranges array<struct<a:int,b:int>>"  # first and last of windows in a row that repeat
WINDOW = 35
GRAM = 5
SHARD_WORDS = 20_000  # words of one anchor's passages in an automaton; it may hold as many of other anchors


def _key(text: Column) -> list[Column]:
    """Names of a text: its 64-bit hash and length. Copies share them, and their windows repeat anyway."""
    return [F.xxhash64(text).alias("k"), F.octet_length(text).alias("nb")]


def _longer(window: int, gram: int) -> list[int]:
    """Lengths of the runs that anchors of ever finer routing come from; the last is the window itself."""
    out, spread = [], window - gram + 1
    while spread > 1:
        spread = -(-spread // 2)
        out.append(window - spread + 1)
    return out


def _cut_passages(column: pa.Array, window: int, gram: int) -> dict[str, np.ndarray | list]:
    """Passages of whole texts: row, windows first..last with one anchor, and a digest of their words.

    ``twice``: the anchor stands there again, so the passage may repeat within itself.
    """
    spread = window - gram + 1
    data, places = text_bytes(column)
    h, at = word_hashes(data, places)
    del data
    empty = {k: np.zeros(0, np.int64) for k in ("row", "first", "last", "anchor", "twice")} | {"body": []}
    if len(h) < window:
        return empty
    grams = roll(h, gram) | np.uint64(1)
    least = slide(grams, spread, np.minimum)
    # A window lies in one text if the texts of its first and last word are the same.
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    valid = text_of[: len(least)] == text_of[window - 1 :]
    least[~valid] = 0
    begins = valid.copy()
    begins[1:] &= (least[1:] != least[:-1]) | (text_of[1 : len(least)] != text_of[: len(least) - 1])
    first = np.flatnonzero(begins)
    if not len(first):
        return empty
    stops = np.flatnonzero(valid & np.append(~valid[1:] | begins[1:], True))
    # Where a gram is the least of some window it stands as an anchor there.
    padded = np.concatenate([np.zeros(spread - 1, np.uint64), least, np.zeros(spread - 1, np.uint64)])
    stands = np.flatnonzero(slide(padded, spread, np.maximum)[: len(grams)] == grams)
    again = np.zeros(len(stands) + 1, np.int64)
    again[2:] = np.cumsum(
        (grams[stands[1:]] == grams[stands[:-1]]) & (np.diff(stands) <= spread)
    ) if len(stands) > 1 else 0
    lo = np.searchsorted(stands, first)
    hi = np.searchsorted(stands, stops + spread)
    raw = memoryview(h).cast("B")
    spans = zip((first * 8).tolist(), ((stops + window) * 8).tolist(), strict=True)
    row = text_of[first]
    return {
        "row": row,
        "first": first - at[row],
        "last": stops - at[row],
        "anchor": least[first].view(np.int64),
        "twice": again[hi] - again[np.minimum(lo + 1, hi)] > 0,
        "body": [hashlib.md5(raw[a:b], usedforsecurity=False).digest() for a, b in spans],
    }


def _passages(window: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = _cut_passages(batch.column("text"), window, gram)
            row = pa.array(found["row"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(row),
                    batch.column("nb").take(row),
                    pa.array(found["first"], pa.int32()),
                    pa.array(found["last"], pa.int32()),
                    pa.array(found["anchor"]),
                    pa.array(found["body"], pa.binary()),
                    pa.array(found["twice"], pa.bool_()),
                ],
                ["k", "nb", "first", "last", "anchor", "body", "twice"],
            )

    return cut


def passages(docs: DataFrame, text: Column, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(k, nb, first, last, anchor, body, twice) of every text; ``twice``: its anchor stands there again."""
    rows = docs.select(*_key(text), text.alias("text"))
    return materialize(
        rows.mapInArrow(
            _passages(window, gram), "k long, nb int, first int, last int, anchor long, body binary, twice boolean"
        )
    )


class Automaton:
    """Suffix automaton of several word sequences, with counts of how often each state's words occur."""

    def __init__(self) -> None:
        self.go: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _extend(self, last: int, word: int) -> int:
        go, link, length = self.go, self.link, self.length
        known = go[last].get(word)
        if known is not None:
            if length[known] == length[last] + 1:
                return known
            return self._clone(last, word, known)
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.count.append(0)
        p = last
        while p != -1 and word not in go[p]:
            go[p][word] = new
            p = link[p]
        if p != -1:
            q = go[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: int, q: int) -> int:
        go, link, length = self.go, self.link, self.length
        copy = len(go)
        go.append(dict(go[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = copy
        while p != -1 and go[p].get(word) == q:
            go[p][word] = copy
            p = link[p]
        return copy

    def add(self, words: list[int], times: int) -> None:
        """Take in one sequence that occurs ``times`` times."""
        last = 0
        for word in words:
            last = self._extend(last, word)
            self.count[last] += times

    def close(self) -> None:
        """Pass the counts on to the suffixes."""
        for state in sorted(range(1, len(self.go)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[int], window: int) -> list[bool]:
        """For each window of a sequence: does its word sequence occur twice in the shard?

        Walks the matching statistics, held at the window length.
        """
        out, state, matched = [], 0, 0
        go, link, length, count = self.go, self.link, self.length, self.count
        for at, word in enumerate(words):
            while state and word not in go[state]:
                state = link[state]
                matched = length[state]
            if word in go[state]:
                state, matched = go[state][word], matched + 1
            while state and length[link[state]] >= window:
                state = link[state]
            matched = min(matched, length[state])
            if at >= window - 1:
                out.append(matched >= window and count[state] >= 2)
        return out


def _texts_of(window: int):
    """Cut the words of wanted passages out of whole texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, bodies, times, words = [], [], [], []
            for value, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                split = value.encode().split()
                for w in wanted:
                    anchors.append(w["anchor"])
                    bodies.append(w["body"])
                    times.append(w["n"])
                    words.append(b" ".join(split[w["first"] : w["last"] + window]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(bodies, pa.binary()), pa.array(times, pa.int64()), pa.array(words, pa.binary())],
                ["anchor", "body", "n", "words"],
            )

    return cut


def _ranges(flags: list[bool]) -> list[tuple[int, int]]:
    """First and last of each run of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(flags, np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _judge(window: int, shard_words: int):
    """Automata of shards of whole anchors; rows come sorted by anchor."""

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        automaton = Automaton()
        coded = [[number.setdefault(w, len(number)) for w in words.split(b" ")] for _, _, _, words in rows]
        for (_, _, n, _), words in zip(rows, coded, strict=True):
            automaton.add(words, n)
        automaton.close()
        out = [
            (anchor, body, [{"a": a, "b": b} for a, b in found])
            for (anchor, body, _, _), words in zip(rows, coded, strict=True)
            if (found := _ranges(automaton.repeated(words, window)))
        ]
        if out:
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "body", "ranges"]
            )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "body", "n", "words")), strict=True):
                if held >= shard_words and rows[-1][0] != row[0]:
                    yield from shard(rows)
                    rows, held = [], 0
                rows.append(row)
                held += row[3].count(b" ") + 1
        if rows:
            yield from shard(rows)

    return judge


def _route_again(window: int, gram: int):
    """Passages of passages by longer runs of words, with their words and place.

    At the last level equal windows in a row are one row that stands for all of
    them (``upto`` more), with the words of one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "words")):
            found = _cut_passages(batch.column("words"), window, gram)
            row = pa.array(found["row"])
            first, last = found["first"], found["last"]
            upto = last - first if gram == window else np.zeros_like(first)
            split: list[bytes] = []
            held, words, bodies = -1, [], []
            texts = batch.column("words")
            for r, lo, hi, body in zip(found["row"].tolist(), first.tolist(), (last - upto).tolist(), found["body"], strict=True):
                if r != held:
                    held, split = r, texts[r].as_py().split(b" ")
                words.append(b" ".join(split[lo : hi + window]))
                # The digest of one window, where a row stands for several.
                bodies.append(hashlib.md5(words[-1], usedforsecurity=False).digest() if gram == window else body)
            times = batch.column("n").take(row).to_numpy(zero_copy_only=False) * (upto + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("anchor").take(row),
                    batch.column("body").take(row),
                    pa.array(first, pa.int32()),
                    pa.array(upto, pa.int32()),
                    pa.array(found["anchor"]),
                    pa.array(bodies, pa.binary()),
                    pa.array(found["twice"], pa.bool_()),
                    pa.array(times, pa.int64()),
                    pa.array(words, pa.binary()),
                ],
                ["anchor", "body", "at", "upto", "anchor2", "body2", "twice", "n", "words"],
            )

    return cut


def _size() -> Column:
    """Words of a passage: they are joined by one blank each."""
    return F.octet_length("words") - F.octet_length(F.expr("replace(cast(words as string), ' ', '')")) + 1


def _copies(rows: DataFrame, window: int) -> DataFrame:
    """Passages that repeat as a whole, as (anchor, body, ranges)."""
    whole = F.struct(F.lit(0).alias("a"), (F.col("size") - window).cast("int").alias("b"))
    return rows.select("anchor", "body", F.array(whole).alias("ranges"))


def _decide(rows: DataFrame, window: int, grams: list[int], shard_words: int) -> DataFrame:
    """(anchor, body, ranges): windows of distinct passages (anchor, body, n, size, words) that repeat among them."""
    held = rows.groupBy("anchor").agg(F.sum("size").alias("held"))
    sized = rows.join(held, "anchor")
    large = materialize(sized.filter(F.col("held") > shard_words).drop("held")) if grams else None
    if large is None or large.isEmpty():
        small, later = rows, None
    else:
        small = sized.filter(F.col("held") <= shard_words).drop("held")
        later = _decide_finer(large, window, grams, shard_words)
    dealt = small.select("anchor", "body", "n", "words").repartition("anchor").sortWithinPartitions("anchor", "body")
    judged = dealt.mapInArrow(_judge(window, shard_words), f"anchor long, body binary, {RANGES}")
    return judged if later is None else judged.unionByName(later)


def _decide_finer(large: DataFrame, window: int, grams: list[int], shard_words: int) -> DataFrame:
    """Passages of anchors that hold too many words, routed again by anchors over longer runs."""
    cut = materialize(
        large.select("anchor", "body", "n", "words").mapInArrow(
            _route_again(window, grams[0]),
            "anchor long, body binary, at int, upto int, anchor2 long, body2 binary, twice boolean, n long, words binary",
        )
    )
    distinct = cut.groupBy(F.col("anchor2").alias("anchor"), F.col("body2").alias("body")).agg(
        F.sum("n").alias("n"), F.max("twice").alias("twice"), F.max("words").alias("words")
    )
    distinct = materialize(distinct.withColumn("size", _size()))
    met = distinct.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("bodies"), F.sum(F.col("n") + F.col("twice").cast("int")).alias("times")
    )
    split = materialize(distinct.join(met.filter("times > 1"), "anchor"))
    whole = (F.col("bodies") == 1) & (F.col("n") > 1)
    rest = split.filter(~whole).select("anchor", "body", "n", "size", "words")
    verdict = _copies(split.filter(whole), window).unionByName(_decide(rest, window, grams[1:], shard_words))
    found = verdict.select(F.col("anchor").alias("anchor2"), F.col("body").alias("body2"), "ranges")
    moved = F.transform(
        "ranges",
        lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"] + F.col("upto")).alias("b")),
    )
    # One row a passage: the ranges of its parts meet again above, before anything is joined.
    joined = cut.join(found, ["anchor2", "body2"]).select("anchor", "body", moved.alias("ranges"))
    return joined.groupBy("anchor", "body").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def repeated_spans(docs: DataFrame, text: Column, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(k, nb, spans): word spans (first, end) of each text that repeated windows cover; others have no row."""
    every = passages(docs, text, window)
    seen = every.groupBy("anchor").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("c")).filter("c > 1").select("anchor")
    again = materialize(every.join(seen, "anchor"))
    # Copies of a passage fold into one row with a count and one place to read it.
    place = F.struct("k", "nb", "first", "last")
    distinct = materialize(
        again.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    )
    met = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("bodies"))
    # A lone passage met twice is a copy as a whole; every other one is for the automata.
    split = distinct.join(met, "anchor").withColumn("whole", (F.col("bodies") == 1) & (F.col("n") > 1))
    asked = materialize(
        split.filter(~F.col("whole"))
        .groupBy("place.k", "place.nb")
        .agg(
            F.collect_list(
                F.struct("anchor", "body", "n", F.col("place.first").alias("first"), F.col("place.last").alias("last"))
            ).alias("wanted")
        )
    )
    source = docs.select(*_key(text), text.alias("text")).join(asked, ["k", "nb"])
    words = materialize(
        source.select("text", "wanted")
        .mapInArrow(_texts_of(window), "anchor long, body binary, n long, words binary")
        # Copies of a text give the same passage again.
        .groupBy("anchor", "body")
        .agg(F.max("n").alias("n"), F.max("words").alias("words"))
        .withColumn("size", _size())
    )
    whole = split.filter("whole").withColumn("size", F.col("place.last") - F.col("place.first") + window)
    verdict = _copies(whole, window).unionByName(_decide(words, window, _longer(window, GRAM), shard_words))
    spans = F.transform(
        "ranges",
        lambda r: F.struct((F.col("first") + r["a"]).alias("a"), (F.col("first") + r["b"] + window).alias("b")),
    )
    placed = again.join(verdict, ["anchor", "body"]).select("k", "nb", spans.alias("spans"))
    return placed.groupBy("k", "nb").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _removed(n: int, spans: list | None) -> np.ndarray:
    """Which of ``n`` words the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        edge[s["a"]] += 1
        edge[min(s["b"], n)] -= 1
    return np.cumsum(edge[:-1]) > 0


def _with_spans(docs: DataFrame, text: str, window: int, shard_words: int) -> tuple[DataFrame, str]:
    """``docs`` with the spans of each text, and the name of their column."""
    body = F.coalesce(F.col(text), F.lit(""))
    k, nb, own_k, own_nb, spans = fresh(docs, "k", "nb", "own_k", "own_nb", "spans")
    found = repeated_spans(docs, body, window, shard_words).withColumnsRenamed({"k": k, "nb": nb, "spans": spans})
    mark, size = _key(body)
    rows = docs.withColumns({own_k: mark, own_nb: size})
    return rows.join(found, (F.col(own_k) == F.col(k)) & (F.col(own_nb) == F.col(nb)), "left"), spans


def _removed(n: int, spans: list | None) -> np.ndarray:
    """Which of ``n`` words the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        edge[s["a"]] += 1
        edge[min(s["b"], n)] -= 1
    return np.cumsum(edge[:-1]) > 0


def digest_kept(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row.

    Null and empty texts have no words. Repeated rows are copies of one another,
    so all their windows repeat; rows with a null key count like any other.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = (value or "").encode().split()
                if spans:
                    gone = _removed(len(words), spans)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                ["key", "n_words", "n_removed", "kept_sha256"],
            )

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows, spans = _with_spans(slim, "text", window, shard_words)
    return rows.select("key", "text", F.col(spans).alias("spans")).mapInArrow(
        digest, "key long, n_words long, n_removed long, kept_sha256 string"
    ).withColumnRenamed("key", key)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The same rows with repeated words cut out of ``text``; texts without any stay byte for byte.

    A cut takes the words and the white space after them.
    """
    @pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for value, found in zip(texts, spans, strict=True):
            if value is None or found is None or not len(found):
                out.append(value)
                continue
            data = value.encode()
            raw = np.frombuffer(data, np.uint8)
            gap = SPACES[raw]
            first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
            gone = _removed(len(first), found)
            keep = np.ones(len(raw), bool)
            ends = np.append(first[1:], len(raw))
            for a, b in _ranges(gone):
                keep[first[a] : ends[b]] = False
            out.append(raw[keep].tobytes().decode())
        return pd.Series(out, dtype=object)

    rows, name = _with_spans(docs, text, window, SHARD_WORDS)
    return rows.select(*[cut(docs[text], F.col(name)).alias(text) if c == text else docs[c] for c in docs.columns])
