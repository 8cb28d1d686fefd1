"""Licence scans: Aho-Corasick over word streams, shunting-yard over licence expressions."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# The notice phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further phrases of the method, with labels of their own and the weight of one sighting.
PHRASES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "creative commons attribution": ("creative-commons", 0.8),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "unlicense": ("unlicense", 0.6),
    "public domain": ("public-domain", 0.4),
    "all rights reserved": ("proprietary", 0.4),
    "permission is hereby granted free of charge": ("mit-notice", 0.8),
    "redistribution and use in source and binary forms": ("bsd-notice", 0.8),
    "licensed under": ("licensed", 0.3),
    "released under": ("licensed", 0.3),
    "distributed under": ("licensed", 0.3),
    "available under": ("licensed", 0.3),
    "spdx license identifier": ("spdx-tag", 0.9),
}
BASE_WEIGHT = 0.8

# Families of the public identifier list, without their versions and endings.
FAMILIES = (
    "0bsd afl agpl apache artistic apsl bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear "
    "bsd-4-clause bsl cc-by cc-by-nc cc-by-nc-nd cc-by-nc-sa cc-by-nd cc-by-sa cc0 cddl cecill cecill-b cecill-c cpl "
    "ecl epl eupl gfdl gpl ipl isc lgpl lppl mit mit-0 mpl ms-pl ms-rl mulanpsl ncsa odbl ofl openssl osl php "
    "postgresql psf python qpl ruby sleepycat unicode unlicense upl vim w3c wtfpl x11 zlib zpl"
).split()
_ENDING = r"(?:-[0-9][0-9.]*)?(?:\+|-only|-or-later|-no-copyleft-exception|-invariants(?:-only|-or-later)?)?"
_LISTED = re.compile(rf"(?:{'|'.join(map(re.escape, sorted(FAMILIES, key=len, reverse=True)))}){_ENDING}")
# Those that ask for the same terms in derived works.
SHARE_ALIKE = "agpl apsl cc-by-nc-sa cc-by-sa cddl cecill cpl epl eupl gfdl gpl ipl lgpl mpl ms-rl odbl osl qpl sleepycat".split()
_SHARE_ALIKE = re.compile(rf"(?:{'|'.join(map(re.escape, sorted(SHARE_ALIKE, key=len, reverse=True)))}){_ENDING}")

# Names of licences in prose, as words, and the families they stand for.
PROSE = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "apache license": "apache",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "mit license": "mit",
    "mit": "mit",
    "isc license": "isc",
    "unlicense": "unlicense",
    "cc by": "cc-by",
    "creative commons attribution": "cc-by",
}
_NAMES: dict[str, list[tuple[list[str], str]]] = {}
for _name, _family in sorted(PROSE.items(), key=lambda x: -len(x[0].split())):
    _NAMES.setdefault(_name.split()[0], []).append((_name.split(), _family))
_VERSION = re.compile("v?([0-9]{1,2})")
_FILLERS = {"the", "a", "either", "both", "terms", "of"}
_PARTS = {"nc": "nc", "nd": "nd", "sa": "sa", "noncommercial": "nc", "noderivatives": "nd", "sharealike": "sa"}

_TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_RANK = {"with": 3, "and": 2, "or": 1}

# Bytes outside words become blanks; A-Z become a-z; bytes of other scripts stay.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def to_postfix(expression: str) -> list[str] | None:
    """Postfix form of an and/or/with expression (shunting-yard); None if it is not well formed.

    Reading stops at the first character that cannot belong to an expression, so
    a comment end after the tag does no harm.
    """
    out: list[str] = []
    held: list[str] = []
    operand_next, at, text = True, 0, expression.lower()
    while at < len(text):
        if text[at] in " \t":
            at += 1
            continue
        found = _TOKEN.match(text, at)
        if not found:
            break
        token, at = found[0], found.end()
        if token == "(":
            if not operand_next:
                return None
            held.append(token)
        elif token == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif token in _RANK:
            if operand_next:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool] | None:
    """Licences of an expression, and whether some choice under it asks for no share-alike terms.

    ``or`` is satisfied by either side, ``and`` needs both; ``with`` joins one
    licence and one exception, and None is returned where it stands between
    anything else. Work is linear in the expression.
    """
    names: set[str] = set()
    stack: list[tuple[str | None, bool]] = []  # the name of a lone licence, and whether its terms are free
    for token in postfix:
        if token not in _RANK:
            stack.append((token, not _SHARE_ALIKE.fullmatch(token)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if left[0] is None or right[0] is None or "-with-" in left[0]:
                return None
            stack.append((f"{left[0]}-with-{right[0]}", left[1]))
        else:
            names |= {x for x, _ in (left, right) if x is not None}
            stack.append((None, left[1] and right[1] if token == "and" else left[1] or right[1]))
    if stack[-1][0] is not None:
        names.add(stack[-1][0])
    return names, stack[-1][1]


def prose_expression(words: list[str], at: int) -> str:
    """The licence expression that the words from ``at`` on spell out, as identifiers; empty if they do not.

    Names and versions are read to the first word that belongs to neither.
    """
    out: list[str] = []
    while at < len(words):
        word = words[at]
        after_name = bool(out) and out[-1] not in _RANK
        if word in _RANK and after_name:
            out.append(word)
            at += 1
            continue
        if word in _FILLERS and not after_name:
            at += 1
            continue
        found = next(((n, f) for n, f in _NAMES.get(word, ()) if words[at : at + len(n)] == n), None)
        if found is None or after_name:
            break
        at += len(found[0])
        name, version = found[1], []
        while name.startswith("cc-by") and at < len(words) and words[at] in _PARTS:
            name, at = f"{name}-{_PARTS[words[at]]}", at + 1
        if at + 1 < len(words) and words[at] in ("version", "v") and _VERSION.fullmatch(words[at + 1]):
            at += 1
        while at < len(words) and len(version) < 2 and (digits := _VERSION.fullmatch(words[at])):
            version.append(digits[1])
            at += 1
        out.append("-".join([name, *([".".join(version)] if version else [])]))
    while out and out[-1] in _RANK:
        out.pop()
    return " ".join(out)


def expression_labels(expression: str) -> set[str]:
    """Labels of one expression: its listed licences, ``spdx:unlisted`` for other names, and its terms."""
    postfix = to_postfix(expression)
    found = evaluate(postfix) if postfix else None
    if found is None:
        return set()
    # Identifiers hold no comma, and listed ones are short.
    labels = set()
    for name in found[0]:
        base, _, exception = name.partition("-with-")
        listed = _LISTED.fullmatch(base) and len(exception) < 60
        labels.add(f"spdx:{name}" if listed else "spdx:unlisted")
    return labels | {"terms:free-choice" if found[1] else "terms:share-alike"}


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    """All phrases with a blank on both sides: a match is whole words in a row."""
    found = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        found.add_word(f" {phrase} ", (len(phrase), label, BASE_WEIGHT, True))
    for phrase, (label, weight) in PHRASES.items():
        found.add_word(f" {phrase} ", (len(phrase), label, weight, False))
    found.make_automaton()
    return found


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """Words, base places, first and last base word, base labels, all labels and a score.

    The score is one minus the product of the misses of all sightings. Null and
    texts without words have no place, no label and score 0.
    """
    raw = (text or "").encode()
    words = raw.translate(_WORDS).split()
    # One character a byte: phrases are ASCII, and counting blanks gives the word number.
    stream = f" {b' '.join(words).decode('latin-1')} "
    base, labels, miss, n_base = set(), set(), 1.0, 0
    starts: list[int] = []
    cues: list[int] = []  # words after which a licence may be named
    number, counted = 0, 0
    for end, (length, label, weight, is_base) in _automaton().iter(stream):
        labels.add(label)
        miss *= 1 - weight
        if is_base or label == "licensed":
            # Ends come in order and a phrase starts before its end, so count from the end.
            number += stream.count(" ", counted, end)
            counted = end
            if is_base:
                starts.append(number - 1 - stream.count(" ", end - length, end))
                base.add(label)
                n_base += 1
            else:
                cues.append(number)
    if "spdx-tag" in labels:
        for tag in _TAG.finditer(raw.lower()):
            labels |= expression_labels(tag[1].decode("utf-8", "replace"))
    if cues:
        spelled = [w.decode() for w in words]
        for at in cues:
            labels |= expression_labels(prose_expression(spelled, at))
    return (
        len(words),
        n_base,
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1 - miss,
    )


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def license_scan(text: Column) -> Column:
    """Struct of ``FIELDS`` for each whole text."""

    @pandas_udf(FIELDS)
    def run(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([scan(t) for t in texts], columns=[f.split()[0] for f in FIELDS.split(", ")])
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return run(text)
