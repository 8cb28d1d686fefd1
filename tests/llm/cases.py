"""Small tables with the awkward cases every operator has to take, and plain forms of the rules."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, _found int, k long, _hits string, fp long"

VOCABULARY = "the of and house river stone walks slowly under bright morning sky while seven birds sing".split()


def sentence(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + str(r.randrange(50)) for _ in range(n))


PASSAGE = sentence(1, 60)


def rows():
    long = sentence(2, 40_000)
    texts = [
        (1, sentence(3, 80)),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long),
        (6, f"start six {PASSAGE} end six"),
        (7, f"start seven {PASSAGE} end seven"),
        (8, sentence(4, 120)),
        (8, sentence(4, 120)),
        (9, sentence(4, 120)),
        (None, sentence(5, 50)),
        (None, None),
        (10, "same " * 90),
        (11, "write to ann.lee@mail.example.com or +1 (017) 555-7713, card 4111 1111 1111 1111, host 10.0.0.255"),
        (12, "été déjà vu — 漢字 😀 naïve"),
        (13, "12345 !!! ???"),
    ]
    return [
        (i, t, "en" if i != 12 else None, "s", None if t is None else len(t), "clash", 7, 8, "clash", 9)
        for i, t in texts
    ]


def table(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
]


def base_spans(text):
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern, good) in enumerate(BASE)
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def uncovered(texts, window):
    """For each text: which words no repeated window covers."""
    counts = {}
    split = [words(t) for t in texts]
    for w in split:
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            counts[s] = counts.get(s, 0) + 1
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def best_fit(lengths, size):
    """Sequences that packing piece by piece opens."""
    import bisect

    rooms, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        if at == len(rooms):
            opened += 1
            room = size
        else:
            room = rooms.pop(at)
        bisect.insort(rooms, room - n)
    return opened
