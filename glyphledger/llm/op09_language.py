"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from glyphledger.llm.columns import fresh
from glyphledger.session import materialize

UNDETERMINED = "und"
ORDER = 3  # longest n-gram, in letters and word gaps
TOP = 400  # ranks in a profile; also the penalty of an n-gram outside it
LANGUAGES = 4096  # more learned languages than this are refused: bounds the profile table
REJECT_BELOW = 0.30  # least score of an accepted document: learned languages score more, unlearned ones and random letters less
SHORT = 64  # texts of fewer distinct n-grams, about 30 letters, are too short for that
REJECT_SHORT_BELOW = 0.15  # least score of an accepted short text
_PIECE = 1 << 18  # characters worked on at once
_FLUSH = 1 << 20  # distinct n-grams a training task holds


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to ``ORDER`` characters of a whole text, as numbers, with their counts.

    Letters are lower-cased; everything between two letters is one gap. A gap
    alone is no n-gram. Long texts are worked on piece by piece.
    """
    found, carry = [], np.ones(1, np.int64)
    text = text or ""
    for at in range(0, len(text) + 1, _PIECE):
        last = int(at + _PIECE > len(text))
        points = np.frombuffer(text[at : at + _PIECE].lower().encode("utf-32-le"), "<u4").astype(np.int64)
        # 1 is a gap; letters are their code point + 1, so no n-gram is a prefix of another number.
        seq = np.concatenate([carry, np.where(_letters()[points], points, 0) + 1, np.ones(last, np.int64)])
        keep = np.ones(len(seq), bool)
        keep[1:] = (seq[1:] != 1) | (seq[:-1] != 1)
        seq, old = seq[keep], len(carry)
        number = np.zeros(len(seq), np.int64)
        parts = []
        for n in range(1, ORDER + 1):
            number = (number[: len(seq) - n + 1] << 21) | seq[n - 1 :]
            new = number[max(0, old - n + 1) :]
            parts.append(new[new != 1] if n == 1 else new)
        parts = np.sort(np.concatenate(parts))
        first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, int)
        found.append((parts[first], np.diff(np.append(first, len(parts)))))
        carry = seq[1 - ORDER :] if len(seq) >= ORDER else seq
    return found[0] if len(found) == 1 else _merge(found)


def _merge(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in found]))
    return grams, counts


def _ranked(text: str | None) -> np.ndarray:
    """The most frequent n-grams first; ties by the n-gram itself."""
    grams, counts = gram_counts(text)
    if len(grams) > TOP:
        floor = np.partition(counts, len(counts) - TOP)[len(counts) - TOP]
        grams, counts = grams[counts >= floor], counts[counts >= floor]
    return grams[np.lexsort((grams, -counts))][:TOP]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, rank): the ``TOP`` most frequent n-grams of each language, ranked from 0.

    Learns from every row with a non-null text and language; counts are summed in
    tasks first, so a language that holds most rows is no hot key.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name, found in held.items():
                grams, counts = _merge(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                    ["lang", "gram", "n"],
                )

        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got = gram_counts(value)
                held.setdefault(name, []).append(got)
                size += len(got[0])
                if size > _FLUSH:
                    held = {k: [_merge(v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > _FLUSH // 2:
                        yield from out()
                        held, size = {}, 0
        yield from out()

    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("rank", place).filter(F.col("rank") <= TOP).select("lang", "gram", (F.col("rank") - 1).alias("rank"))


class Profiles:
    """Ranks of all learned n-grams, one column per language; a fixed bound of rows."""

    def __init__(self, rows: list) -> None:
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.fromiter((r["gram"] for r in rows), np.int64, len(rows)))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        col = {name: i for i, name in enumerate(self.langs)}
        for r in rows:
            self.ranks[np.searchsorted(self.grams, r["gram"]), col[r["lang"]]] = r["rank"]

    @classmethod
    def collect(cls, profiles: DataFrame) -> Profiles:
        """Bring the profiles, at most ``TOP`` rows a language, to the driver."""
        profiles = materialize(profiles)
        if profiles.count() > TOP * LANGUAGES:
            raise ValueError(f"more than {LANGUAGES} languages were learned")
        return cls(profiles.collect())

    def predict(self, text: str | None) -> tuple[str, float]:
        return self._nearest(_ranked(text))

    def accepts(self, text: str | None, least: float = REJECT_BELOW) -> bool:
        """Whether a text is in a learned language; short texts only have to be near one."""
        mine = _ranked(text)
        lang, score = self._nearest(mine)
        return lang != UNDETERMINED and score >= (min(least, REJECT_SHORT_BELOW) if len(mine) < SHORT else least)

    def _nearest(self, mine: np.ndarray) -> tuple[str, float]:
        if not len(mine) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, mine)
        at[at < len(self.grams)] = np.where(
            self.grams[at[at < len(self.grams)]] == mine[at < len(self.grams)], at[at < len(self.grams)], len(self.grams)
        )
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, TOP, np.abs(theirs - np.arange(len(mine))[:, None]))
        distance = apart.sum(0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (TOP * len(mine)))


def language(profiles: Profiles, text: Column) -> Column:
    """Struct (lang_pred, score): the nearest profile and one minus its share of the largest distance.

    ``und`` and 0 for null, for texts without a letter and when nothing was learned.
    Equal distances go to the first language by name.
    """
    shared = profiles

    @pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def training_rows(docs: DataFrame, key: str = "doc_id", folds: int = 4, held: int = 2) -> DataFrame:
    """Rows outside the held-out fold; a null key hashes as the empty text."""
    return docs.filter(~held_out(F.col(key), folds, held))


def held_out(key: Column, folds: int = 4, held: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == held


def accept(docs: DataFrame, profiles: Profiles, text: str = "text", least: float = REJECT_BELOW) -> DataFrame:
    """Rows in a learned language. Rejected: no letter, null, or too far from every profile."""
    shared = profiles

    @pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.accepts(t, least) for t in texts], dtype=bool)

    (kept,) = fresh(docs, "kept")
    seen = docs.withColumn(kept, good(F.col(text)))
    return seen.filter(F.col(kept)).select(*[docs[c] for c in docs.columns])
