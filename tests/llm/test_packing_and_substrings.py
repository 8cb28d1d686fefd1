import hashlib
import random
import zlib

import numpy as np
import pytest

from glyphledger.llm import op02_packing as o2
from glyphledger.llm import op03_substrings as o3
from glyphledger.llm.queries import tokenizer_path
from glyphledger.llm.words import roll, slide, text_bytes, word_hashes
from tests.llm import cases

PATH = tokenizer_path("word_bpe_49k.json")


def spread(steps, counts):
    """Bins that a plan fills: bin -> [(offset, length)]."""
    bins, seen = {}, {}
    for length, first, each, start, offset in steps:
        assert seen.get(length, 0) <= first
        n = 0
        later = [s[1] for s in steps if s[0] == length and s[1] > first]
        until = min(later, default=counts[length])
        for nth in range(first, until):
            at = nth - first
            bins.setdefault(start + at // each, []).append((offset + at % each * length, length))
            n += 1
        seen[length] = first + n
    assert seen == counts
    return bins


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    size = r.choice([10, 64, 2048])
    counts = {}
    for _ in range(r.randrange(1, 200)):
        n = min(size, 1 + int(r.expovariate(4 / size)))
        counts[n] = counts.get(n, 0) + r.choice([1, 1, 2, 40])
    bins = spread(o2.plan(counts, size), counts)
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    assert len(bins) == cases.best_fit([n for n, c in counts.items() for _ in range(c)], size)


def test_plan_of_nothing():
    assert o2.plan({}, 10) == []


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(PATH), o2.WordIds(PATH, room=40)
    texts = [r[1] or "" for r in cases.rows() if r[0] != 5]
    texts += ["don't we'll  I'D x y <|endoftext|> a<|startoftext|>b ΑΣ ΣΑΣ. é İI \x1c \x85 ok", "x" * 500]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.ids(text.encode()), "<u4").tolist() == want


@pytest.mark.parametrize("size", [16, 2048])
def test_packs_the_awkward_table(spark, size):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rows = cases.rows()
    got = [r.asDict() for r in o2.pack_documents(cases.table(spark), PATH, size=size).collect()]
    ids = [(r[0], [*plain.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows]
    want = [
        (k, i, lo, len(x[lo : lo + size]), zlib.crc32(np.array(x[lo : lo + size], "<u4").tobytes()))
        for k, x in ids
        for i, lo in enumerate(range(0, len(x), size))
    ]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in places.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    assert len(places) == cases.best_fit([w[3] for w in want], size)


def test_packs_no_documents(spark):
    assert o2.pack_documents(cases.table(spark, []), PATH).count() == 0


def test_word_hashes_follow_words_wherever_texts_are_cut(monkeypatch):
    import pyarrow as pa

    import glyphledger.llm.words as w

    texts = ["a bb", None, "", "bb", "  x\ty\nz  ", "a", "ab", "É", cases.sentence(1, 400), "z" * 9000, "end"]
    monkeypatch.setattr(w, "_CHUNK", 50)
    h, at = word_hashes(*text_bytes(pa.array(texts)))
    monkeypatch.setattr(w, "_CHUNK", 1 << 20)
    again, places = word_hashes(*text_bytes(pa.array(texts)))
    assert (h == again).all() and (at == places).all()
    flat = [x for t in texts for x in cases.words(t)]
    assert len(h) == len(flat) and len(set(zip(h.tolist(), flat, strict=True))) == len(set(flat)) == len(set(h.tolist()))
    assert np.diff(at).tolist() == [len(cases.words(t)) for t in texts]
    upper, _ = word_hashes(*text_bytes(pa.array(["ABC abc"])), lower=True)
    assert upper[0] == upper[1]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 31, 35])
def test_rolling_forms(n):
    r = np.random.default_rng(n)
    values = r.integers(0, 4, 200).astype(np.uint64)
    least = slide(values, n, np.minimum)
    assert least.tolist() == [int(values[i : i + n].min()) for i in range(200 - n + 1)]
    marks = roll(values, n)
    runs = [tuple(values[i : i + n].tolist()) for i in range(200 - n + 1)]
    assert len(set(zip(marks.tolist(), runs, strict=True))) == len(set(runs)) == len(set(marks.tolist()))


@pytest.mark.parametrize("seed", range(8))
def test_automaton_counts_windows(seed):
    r = random.Random(seed)
    texts = [[r.randrange(2 + seed % 3) for _ in range(r.randrange(1, 60))] for _ in range(12)]
    times = [r.choice([1, 1, 1, 3]) for _ in texts]
    window = 6
    automaton = o3.Automaton()
    for t, n in zip(texts, times, strict=True):
        automaton.add(t, n)
    automaton.close()
    counts = {}
    for t, n in zip(texts, times, strict=True):
        for i in range(len(t) - window + 1):
            counts[tuple(t[i : i + window])] = counts.get(tuple(t[i : i + window]), 0) + n
    strange = [r.randrange(5) for _ in range(80)]
    for t in [*texts, strange]:
        want = [counts.get(tuple(t[i : i + window]), 0) > 1 for i in range(len(t) - window + 1)]
        assert automaton.repeated(t, window) == want


def digests(texts, window):
    out = []
    for t, kept in zip(texts, cases.uncovered(texts, window), strict=True):
        n = len(cases.words(t))
        out.append((n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def test_removes_from_the_awkward_table(spark):
    rows = cases.rows()
    got = sorted(map(tuple, o3.digest_kept(cases.table(spark)).collect()), key=str)
    assert got == sorted([(r[0], *d) for r, d in zip(rows, digests([r[1] for r in rows], 35), strict=True)], key=str)


@pytest.mark.parametrize("shard_words", [1, 100, 20_000])
def test_removes_what_all_windows_say(spark, shard_words):
    """Shards of any size give the same: small ones route passages again, down to single windows."""
    r = random.Random(shard_words)
    pool = [cases.sentence(i, r.randrange(30, 90)).split() for i in range(6)]
    texts = []
    for i in range(60):
        parts = cases.sentence(100 + i, r.randrange(0, 60)).split()
        for _ in range(r.randrange(3)):
            piece = r.choice(pool)
            a = r.randrange(20)
            parts += piece[a : len(piece) - r.randrange(10)] + cases.sentence(r.randrange(10**6), r.randrange(4)).split()
        texts.append(" ".join(parts))
    texts += ["ab " * 80, "x y " * 60, "x y " * 50 + "z", *texts[:3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(x)[1:] for x in sorted(o3.digest_kept(docs, shard_words=shard_words).collect())]
    assert got == digests(texts, 35)


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_and_passages_made_to_clash(spark):
    """Swapped blocks of 65,536 bytes and Thue-Morse words of 1,024 letters are words of their own."""
    a, b = "a" * 65536, "b" * 65536
    swapped = [a + b, b + a]
    morse = [thue_morse(1024, "x", "y"), thue_morse(1024, "y", "x")]
    h, _ = word_hashes(*text_bytes(__import__("pyarrow").array([" ".join([*swapped, *morse])])))
    assert len(set(h.tolist())) == 4
    tail = cases.sentence(3, 40)
    texts = [f"{w} {tail}" for w in [swapped[0], swapped[1], morse[0], morse[1]]]
    # Word sequences in that order, of 1,024 words each, differ too.
    texts += [" ".join(thue_morse(1024, "p ", "q ").split()), " ".join(thue_morse(1024, "q ", "p ").split())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(x)[1:] for x in sorted(o3.digest_kept(docs).collect())]
    assert got == digests(texts, 35)


def test_an_anchor_under_most_texts_is_routed_again(spark):
    """One passage in every text, with other words around it each time."""
    common = cases.sentence(8, 60)
    texts = [f"{cases.sentence(1000 + i, 20)} {common} {cases.sentence(3000 + i, 20)}" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(x)[1:] for x in sorted(o3.digest_kept(docs, shard_words=500).collect())]
    assert got == digests(texts, 35) and all(x[1] >= 60 for x in got)


def test_cuts_passages_and_leaves_the_rest_alone(spark):
    docs = cases.table(spark)
    done = o3.remove_repeats(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in done.collect()}
    for key in (1, 2, 3, 4, 5, 11, 12, 13):
        assert after[key] == before[key]
    # Both passages go on with "end", so the windows that reach it repeat too.
    assert after[6] == "start six six" and after[7] == "start seven seven"
    assert after[8] == after[9] == after[10] == ""
    assert o3.remove_repeats(docs.limit(0)).count() == 0
