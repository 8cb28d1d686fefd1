"""Quality rules: a table of thresholds over text measures, compiled into one projection.

Everything is column expressions. Words are cut once; repeated windows are found
by sorting their hashes with their places, inside the row, so nothing is shuffled
and every text costs what it is long.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"  # white space of the contract: 20 and 09-0D
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SHOUTS = r"[!?]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of all words

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be but by for from has have he in is it not of on or that the this to was were which with you "
    "au ce dans de des du elle est et il la le les ne ou par pas pour que qui se sur un une "
    "auf aus das dem den der die ein eine im ist mit nicht oder sich sie und von zu "
    "con del el en es las los más no para por se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low`` <= measure / per <= ``high``; a bound that is None does not bind. ``per`` None divides by one."""

    name: str
    measure: str
    per: str | None
    low: float | None
    high: float | None


# The threshold table. Measures and divisors are the names of ``measures``.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("longest_word", "longest_word", None, None, 1000.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("shouting", "n_shouts", "n_words", None, 0.25),
    Rule("loud_words", "n_loud_words", "n_words", None, 0.4),
    Rule("stop_words", "n_stop_words", "n_words", 0.06, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OTHERS = ("longest_word", "n_shouts", "n_loud_words", "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def passes(rule: Rule, row: Column) -> Column:
    """Whether a struct of measures meets one rule. A ratio over nothing counts as zero."""
    value = row[rule.measure].cast("double")
    if rule.per is not None:
        value = F.when(row[rule.per] > 0, value / row[rule.per]).otherwise(F.lit(0.0))
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (value >= rule.low)
    if rule.high is not None:
        ok = ok & (value <= rule.high)
    return ok


def base_failed(row: Column) -> Column:
    """The contract's rule: too few words, or more than half of them in repeated windows."""
    return (row["n_words"] < LEAST_WORDS) | (100 * row["n_repeat_words"] > MOST_REPEATED * row["n_words"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named.

    The whole judgement stays one expression. As chained columns, a filter on the
    verdict would be pushed below them and repeat the earlier ones at every mention.
    """
    return F.transform(F.array(value), body)[0]


def _repeated(w: Column) -> Column:
    """Places of the windows of ``w`` that stand twice or more, ascending."""
    hashed = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]),
    )

    def same(x: Column, y: Column) -> Column:
        """Equal hashes, and equal words behind them."""
        equal = x["h"] == y["h"]
        for k in range(WINDOW):
            equal = equal & (F.get(w, x["i"] + k) == F.get(w, y["i"] + k))
        return equal

    def places(o: Column) -> Column:
        def pair(x: Column, k: Column) -> Column:
            return _let(F.get(o, k + 1), lambda y: F.when(same(x, y), F.array(x["i"], y["i"])))

        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(F.transform(o, pair)))))

    def ordered(m: Column) -> Column:
        sorted_marks = F.sort_array(F.arrays_zip(m.alias("h"), F.sequence(F.lit(0), F.size(m) - 1).alias("i")))
        return F.when(F.size(F.array_distinct(m)) < F.size(m), _let(sorted_marks, places)).otherwise(
            F.array().cast("array<int>")
        )

    return _let(hashed, ordered)


def _covered(a: Column) -> Column:
    """Words under windows that begin at ``a``; one covers its words up to where the next begins."""
    shares = F.transform(a, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(a, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(shares, F.lit(0), lambda total, n: total + n)


def measures(text: Column) -> Column:
    """Struct of ``BASE`` and ``OTHERS``, all long, for each whole text. A null text has no words."""

    def of(t: Column, w: Column, ls: Column) -> Column:
        value = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)),
            "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
            "n_repeat_words": _let(_repeated(w), _covered),
            "longest_word": F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)),
            "n_shouts": F.regexp_count(t, F.lit(SHOUTS)),
            "n_loud_words": F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x))),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
            "n_lines": F.size(ls),
            "n_bullet_lines": F.size(F.filter(ls, lambda x: F.ltrim(x).rlike(r"^[-*•]"))),
            "n_ellipsis_lines": F.size(F.filter(ls, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
        }
        return F.struct(*[value[k].cast("long").alias(k) for k in (*BASE, *OTHERS)])

    def split(t: Column) -> Column:
        words = F.array_remove(F.split(t, SPACES, -1), "")
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return _let(words, lambda w: _let(lines, lambda ls: of(t, w, ls)))

    return _let(F.coalesce(text, F.lit("")), split)


def judgement(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The table compiled into one expression: struct of all measures, base_failed, failed (names) and kept."""

    def judged(row: Column) -> Column:
        met = reduce(lambda a, b: a & b, [passes(r, row) for r in rules], F.lit(True))
        named = F.array(*[F.when(~passes(r, row), F.lit(r.name)) for r in rules]).cast("array<string>")
        return F.struct(
            *[row[k].alias(k) for k in (*BASE, *OTHERS)],
            base_failed(row).alias("base_failed"),
            F.array_compact(named).alias("failed"),
            (~base_failed(row) & met).alias("kept"),
        )

    return _let(measures(text), judged)


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a struct column ``quality``: all measures, base_failed, failed and kept.

    Every row stays, repeated rows and null keys too; null and empty texts have
    no words and are not kept. Texts of any length are judged whole. A column
    ``quality`` of ``docs`` is replaced; no other name can clash.
    """
    return docs.withColumn("quality", judgement(F.col(text), rules))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their own columns."""
    return docs.filter(judgement(F.col(text), rules)["kept"])


def quality_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, base measures, base_failed, kept, failed_rules) of every row; the names are comma-joined."""
    q = docs.select(F.col(key).alias("key"), judgement(F.col(text)).alias("q"))
    named = [F.col(f"q.{c}").alias(c) for c in (*BASE, "base_failed", "kept")]
    return q.select(F.col("key").alias(key), *named, F.array_join("q.failed", ",").alias("failed_rules"))
