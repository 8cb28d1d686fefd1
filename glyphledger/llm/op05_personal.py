"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

All work on text is DataFrame expressions. Patterns give candidate spans;
validity, gazetteer and context labelers vote on each; expectation-maximisation
over the counted vote patterns estimates how reliable each labeler is; the soft
labels then train a log-linear classifier over votes and shape, whose weights go
back into a column expression. Spans of the four base kinds that pass their
validity check always stay; the classifier adds others: kinds without a check
(secrets among them, found by shape and mixture of characters), and near misses
of a check that are likely all the same, under the kind's name with ``_like``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphledger.llm.columns import fresh
from glyphledger.session import materialize

BASE = ("email", "ip", "card", "phone")

# The base patterns of the contract. Possessive forms and look-behinds
# give the same matches without re-reading long runs of letters or digits.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Kinds of the method.
    "email_spelled": (
        r"(?<![A-Za-z0-9])[A-Za-z0-9]++(?:[._-][A-Za-z0-9]++)*+ ?(?:\(at\)|\[at\]) ?"
        r"[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++"
    ),
    "phone_local": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "person": r"\b(?:Mr|Mrs|Ms|Dr|Prof)\. \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?+",
    # A run of 16 or more key characters with a letter and a digit.
    "secret": (
        r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z0-9_+/-]{16})(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])"
        r"[A-Za-z0-9_+/-]++={0,2}+"
    ),
    "password": r"""(?<=(?i:password|passwd|passphrase|pwd)["']?\x20?[:=]\x20?["']?)[^\s"':=,;<>]{4,}+""",
}
KINDS = tuple(PATTERNS)

# A cheap test without which a pattern cannot match.
_NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.contains("+"),
    "email_spelled": lambda t: t.contains("(at)") | t.contains("[at]"),
    "phone_local": lambda t: t.rlike("[0-9]{3}[ .-][0-9]{4}"),
    "person": lambda t: t.contains("Mr") | t.contains("Ms.") | t.contains("Dr.") | t.contains("Prof."),
    "secret": lambda t: t.rlike("[A-Za-z0-9_+/-]{16}"),
    "password": lambda t: t.rlike("(?i)(?:passw|passphrase|pwd)"),
}

# Gazetteers: endings of addresses, calling codes and first digits of card numbers.
ENDINGS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|example"
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
GIVEN_NAMES = "Anna|Carlos|David|Emma|Hans|Jean|John|Juan|Karl|Laura|Luis|Maria|Marie|Michael|Paul|Peter|Pierre|Sarah"

NEAR_WORDS = {
    "email": "mail|contact|write|reach",
    "email_spelled": "mail|contact|write|reach",
    "ip": "ip|host|server|address|from",
    "card": "card|visa|master|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "phone_local": "phone|tel|call|mobile|fax",
    "person": "name|contact|dear|by",
    "secret": "[a-z_-]*(?:token|secret|key|passw|pwd|auth|bearer|credential)",
    "password": "passw|passphrase|pwd|login|user",
}
FAR_WORDS = dict.fromkeys(KINDS, "version|isbn|order|serial|sku|build|release|token|hash|section|figure") | {
    "secret": "sha[0-9]*|md5|commit|checksum|digest|etag|revision|uuid|isbn|sku|version",
    "password": "no|without|forgot|forgotten|reset",
}
# Shapes of issued keys: hex digests of common lengths and well-known prefixes.
KEY_SHAPES = "(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})|(?:AKIA|AIza|gh[pousr]_|xox[abprs]-|sk[-_]|pk_|eyJ).*"
_BEFORE, _AFTER = 32, 8  # characters of context

LABELERS = ("valid", "listed", "near", "far", "edge", "mixed")
SHAPE = ("size", "joined")
ROUNDS = 12


def _hits(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(_NEEDS[kind](text), found).otherwise(F.array().cast("array<string>"))


def _gaps(text: Column, kind: str) -> Column:
    return F.split(text, PATTERNS[kind], -1)


def digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def is_valid(kind: str, span: Column) -> Column:
    """The check of a base kind; null for kinds without one."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(
            F.split(span, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.substring(part(x), 1, 3).cast("int") <= 255)
        )
    if kind == "card":
        return F.length(digits(span)).between(14, 19) & F.call_function("luhn_check", digits(span))
    if kind == "phone":
        return F.length(digits(span)).between(10, 15)
    return F.lit(None).cast("boolean")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(0)


def votes(kind: str, span: Column, before: Column, after: Column) -> dict[str, Column]:
    """1, -1 or 0 (abstains) of each labeler, and the shape features of a span."""
    valid = is_valid(kind, span)
    n_digits = F.length(digits(span))
    # A near miss leaves the check undecided: a mistyped or shortened number may still be one.
    missed = {"card": n_digits.between(14, 19), "phone": n_digits.between(7, 9)}.get(kind, F.lit(False))
    listed = {
        "email": span.rlike(rf"\.(?i:{ENDINGS})$"),
        "email_spelled": span.rlike(rf"(?i:{ENDINGS})$"),
        "ip": ~span.rlike(r"^(?:0|255)\."),
        "card": span.rlike("^[3-6]"),
        "phone": span.rlike(rf"^\+(?:{CALLING})"),
        "phone_local": ~span.rlike(r"^\(?[01]"),
        "person": span.rlike(rf"\b(?:{GIVEN_NAMES})\b"),
        "secret": span.rlike(f"^(?:{KEY_SHAPES})$"),
        "password": span.rlike("[0-9]") & span.rlike("[^0-9]"),
    }[kind]
    # Random keys use many characters and change between letters and digits often.
    distinct = F.size(F.array_distinct(F.split(span, "")))
    turns = F.regexp_count(span, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"))
    random = (distinct >= 9) & (6 * turns >= F.length(span))
    dull = (distinct < 6) | (12 * turns < F.length(span))
    clear = ~before.rlike(r"[\p{L}\p{N}_]$") & ~after.rlike(r"^[\p{L}\p{N}_]")
    return {
        "valid": _vote(valid, ~valid & ~missed),
        "listed": _vote(listed, ~listed),
        "near": _vote(before.rlike(rf"(?i)\b(?:{NEAR_WORDS[kind]})"), F.lit(False)),
        "far": _vote(F.lit(False), before.rlike(rf"(?i)\b(?:{FAR_WORDS[kind]})\b[^\n]{{0,12}}$")),
        "edge": _vote(clear, ~clear),
        "mixed": _vote(random, dull) if kind == "secret" else F.lit(0),
        "size": F.least(F.floor(F.length(span) / 8), F.lit(4)).cast("int"),
        "joined": span.rlike(r"[ ().-]").cast("int"),
    }


@dataclass(frozen=True)
class Classifier:
    """Log-odds: one weight a kind and one for each value of each feature."""

    bias: dict[str, float]
    weight: dict[tuple[str, int], float]

    def probability(self, kind: Column, feature) -> Column:
        total = F.coalesce(*[F.when(kind == k, F.lit(b)) for k, b in self.bias.items()], F.lit(0.0))
        for name in (*LABELERS, *SHAPE):
            values = [(v, w) for (n, v), w in self.weight.items() if n == name]
            total = total + F.coalesce(*[F.when(feature(name) == v, F.lit(w)) for v, w in values], F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All candidate spans of all texts, written as slim rows; a text without any is one row with a null kind.

    ``row`` tells rows of ``docs`` apart (keys may repeat or be null). ``gap`` is
    the length of the text since the last span of the same kind.
    """
    read = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    marked = read.withColumn("row", F.monotonically_increasing_id())
    found = marked.select("row", "key", "t", *[_hits(F.col("t"), k).alias(f"hits_{k}") for k in KINDS])
    cut = found.select(
        "row",
        "key",
        *[f"hits_{k}" for k in KINDS],
        *[F.when(F.size(f"hits_{k}") > 0, _gaps(F.col("t"), k)).alias(f"gaps_{k}") for k in KINDS],
    )

    def spans(kind: str) -> Column:
        hits, gaps = F.col(f"hits_{kind}"), F.col(f"gaps_{kind}")

        def one(hit: Column, i: Column) -> Column:
            before, after = F.get(gaps, i), F.get(gaps, i + 1)
            return F.struct(
                F.lit(kind).alias("kind"),
                i.alias("i"),
                F.length(before).alias("gap"),
                hit.alias("span"),
                F.substring(before, -_BEFORE, _BEFORE).alias("before"),
                F.substring(after, 1, _AFTER).alias("after"),
            )

        return F.transform(hits, one)

    rows = cut.select("row", "key", F.explode_outer(F.concat(*[spans(k) for k in KINDS])).alias("c"))
    flat = rows.select("row", "key", "c.*")
    judged = {k: votes(k, F.col("span"), F.col("before"), F.col("after")) for k in KINDS}
    feature = {
        name: F.coalesce(*[F.when(F.col("kind") == k, own[name]) for k, own in judged.items()])
        for name in (*LABELERS, *SHAPE)
    }
    return materialize(
        flat.select("row", "key", "kind", "i", "gap", F.length("span").alias("length"), *[c.alias(n) for n, c in feature.items()])
    )


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


VALUES = {x: (-1, 0, 1) for x in LABELERS} | {"size": (0, 1, 2, 3, 4), "joined": (0, 1)}


def _weights(table: list, belief: list[float], features: tuple[str, ...]) -> Classifier:
    """Log-odds of kinds and feature values under soft labels, each count one larger."""
    yes, no = ({k: 1.0 for k in [*KINDS, *((f, v) for f in features for v in VALUES[f])]} for _ in range(2))
    for row, q in zip(table, belief, strict=True):
        for k in [row["kind"], *((f, row[f]) for f in features)]:
            yes[k] += row["n"] * q
            no[k] += row["n"] * (1 - q)
    bias = {k: math.log(yes[k] / no[k]) for k in KINDS}
    weight = {}
    for f in features:
        all_yes, all_no = (sum(t[f, v] for v in VALUES[f]) for t in (yes, no))
        for v in VALUES[f]:
            weight[f, v] = math.log(yes[f, v] / all_yes) - math.log(no[f, v] / all_no)
    return Classifier(bias, weight)


def train(cands: DataFrame, rounds: int = ROUNDS) -> Classifier:
    """Estimate the labelers by EM over counted vote patterns, then the classifier from the soft labels.

    Votes are taken as independent given the truth; one reliability table per
    labeler (a share of each vote for true and for false spans) and one prior per
    kind. Spark counts the patterns; their table is bounded by the feature values
    (at most 65,610 rows), whatever the rows. Without candidates all weights are 0.
    """
    names = (*LABELERS, *SHAPE)
    counted = cands.filter("kind is not null").groupBy("kind", *names).agg(F.count(F.lit(1)).alias("n"))
    table = counted.orderBy("kind", *names).collect()
    # Majority of the votes first, pulled towards one half.
    belief = [min(0.95, max(0.05, 0.5 + 0.2 * sum(r[x] for x in LABELERS))) for r in table]
    for _ in range(rounds):
        model = _weights(table, belief, LABELERS)
        belief = [_sigmoid(model.bias[r["kind"]] + sum(model.weight[x, r[x]] for x in LABELERS)) for r in table]
    return _weights(table, belief, names)


def _accepted(model: Classifier, kind: Column, feature) -> Column:
    """Added by the method: likely by the classifier, and not refuted by a check.

    A near miss of a base kind also needs a word nearby that speaks for it; a secret
    that, or the shape of an issued key with no word against it.
    """
    keyed = (kind == "secret") & (feature("listed") == 1) & (feature("far") == 0)
    backed = ~kind.isin(*BASE, "secret") | (feature("near") == 1) | keyed
    return (feature("valid") == 0) & backed & (model.probability(kind, feature) >= 0.5)


def find_spans(cands: DataFrame, model: Classifier) -> DataFrame:
    """(row, key, kind, start, end, base) of every found span; a text without any is one row with a null kind.

    Offsets are code points, the end exclusive. An added span that overlaps a
    base span is left out; an added near miss of a base kind is named ``<kind>_like``.
    """
    running = Window.partitionBy("row", "kind").orderBy("i")
    base = F.col("kind").isin(*BASE) & (F.col("valid") == 1)
    placed = (
        cands.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(running))
        .withColumn("start", F.col("end") - F.col("length"))
        .withColumn("base", F.coalesce(base, F.lit(False)))
        .withColumn("added", F.coalesce(_accepted(model, F.col("kind"), F.col), F.lit(False)))
    )
    upto = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("last_end", F.max(F.when(F.col("base"), F.col("end"))).over(upto)).withColumn(
        "next_start", F.min(F.when(F.col("base"), F.col("start"))).over(down)
    )
    free = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (
        F.col("next_start").isNull() | (F.col("next_start") >= F.col("end"))
    )
    kept = F.col("base") | (F.col("added") & free)
    blank = F.lit(None)
    return seen.select(
        "row",
        "key",
        F.when(F.col("base"), F.col("kind"))
        .when(kept & F.col("kind").isin(*BASE), F.concat("kind", F.lit("_like")))
        .when(kept, F.col("kind"))
        .otherwise(blank)
        .alias("kind"),
        F.when(kept, F.col("start")).otherwise(blank).alias("start"),
        F.when(kept, F.col("end")).otherwise(blank).alias("end"),
        (F.col("base") & kept).alias("base"),
    )


def summarise(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per text: counts and the digest of the base spans, and the list of all spans."""
    number = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate((*KINDS, *(f"{b}_like" for b in BASE)))])
    entry = F.struct(F.col("start"), number.alias("no"), F.col("end"), F.col("kind"))
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    listed = lambda c: F.array_join(F.transform(F.sort_array(c), text), ",")
    # The spans of one text: bounded by its length.
    rows = spans.groupBy("row", "key").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.collect_list(F.when(F.col("base"), entry)).alias("base_spans"),
        F.collect_list(F.when(F.col("kind").isNotNull(), entry)).alias("all_spans"),
    )
    return rows.select(
        F.col("key").alias(key),
        *[f"n_{k}" for k in BASE],
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.col("all_spans")).alias("spans"),
    )


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Train on all candidates of ``docs`` and report its spans. Null texts are empty."""
    cands = candidates(docs, text, key)
    return summarise(find_spans(cands, train(cands)), key)


def mask(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with every base span and every added span of ``text`` replaced by its kind in brackets.

    Kinds are replaced one after the other, so of overlapping spans the first kind
    wins. Null texts stay null; all other columns and all rows stay.
    """
    columns = docs.columns
    h, g = fresh(docs, "hits", "gaps")
    hits, gaps = F.col(h), F.col(g)
    for kind in KINDS:

        def put(hit: Column, i: Column) -> Column:
            before, after = F.substring(F.get(gaps, i), -_BEFORE, _BEFORE), F.substring(F.get(gaps, i + 1), 1, _AFTER)
            found = _accepted(model, F.lit(kind), votes(kind, hit, before, after).__getitem__)  # noqa: B023
            if kind in BASE:  # noqa: B023
                found = is_valid(kind, hit) | found  # noqa: B023
            return F.concat(F.get(gaps, i), F.when(found, F.lit(f"[{kind.upper()}]")).otherwise(hit))  # noqa: B023

        joined = F.concat(F.array_join(F.transform(hits, put), ""), F.element_at(gaps, -1))
        # A step a kind: each works on the text that the one before left.
        docs = (
            docs.withColumn(h, _hits(F.col(text), kind))
            .withColumn(g, F.when(F.size(hits) > 0, _gaps(F.col(text), kind)))
            .withColumn(text, F.when(F.size(hits) > 0, joined).otherwise(F.col(text)))
            .select(*columns)
        )
    return docs
