import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphledger.llm import op11_quality as o11
from glyphledger.llm import op12_alignment as o12
from glyphledger.llm import op13_runs as o13
from glyphledger.llm.queries import tokenizer_path
from tests.llm import cases

BYTES, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")

# ------------------------------------------------------------ quality rules


def plain_measures(text):
    text = text or ""
    w = cases.words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {p for i, x in enumerate(windows) if times[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if cases.words(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_measures_of_the_awkward_table(spark):
    rows = cases.rows()
    extra = [(20 + i, t, "en", "s", 0, "clash", 7, 8, "clash", 9) for i, t in enumerate([
        "a b c a b c", "a a a a", "x\ty\x0bz\x0cq\rw", "l\n\nl\n l\nl", "# * $ %&|<>", "a b c d a b", "one two three one two three one two three",
    ])]
    docs = cases.table(spark, [*rows, *extra])
    got = [tuple(r)[:7] for r in o11.quality_report(docs).drop("kept", "failed_rules").collect()]
    assert sorted(got, key=str) == sorted([(r[0], *plain_measures(r[1])) for r in [*rows, *extra]], key=str)
    assert o11.quality_report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeated_words_equal_all_windows(spark, seed):
    r = random.Random(seed)
    texts = [" ".join(r.choice("abcdefgh"[: r.randrange(1, 9)]) for _ in range(r.randrange(0, 60))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(o11.quality_report(docs).select("doc_id", "n_repeat_words").collect())
    assert [x[1] for x in got] == [plain_measures(t)[4] for t in texts]


def test_rules_decide_and_name_what_fails(spark):
    prose = " ".join(f"the river{i} and a stone{i * 7}" for i in range(30))
    texts = [prose, prose.upper(), prose.replace("river", "#$%river"), " ".join(f"w{i}" for i in range(80)), "the cat", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["quality"] for r in o11.quality(docs).collect()}
    assert got[0]["kept"] and got[0]["failed"] == []
    assert got[1]["failed"] == ["loud_words"] and not got[1]["kept"]
    assert got[2]["failed"] == ["symbols"]
    assert got[3]["failed"] == ["stop_words"] and not got[3]["base_failed"]
    assert got[4]["base_failed"] and got[5]["base_failed"] and not got[5]["kept"]
    assert [r["doc_id"] for r in o11.keep_good(docs).collect()] == [0]
    none = o11.quality(docs, rules=()).filter("quality.kept").select("doc_id").collect()
    assert sorted(r[0] for r in none) == [0, 1, 2, 3]


def test_a_filter_on_the_verdict_does_not_repeat_the_work(spark):
    """The whole judgement is one expression: a filter names it once."""
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = o11.quality_report(docs).filter("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove") <= 2 and "Python" not in plan


def test_labelled_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = o11.quality_report(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").filter("not base_failed")
    share = {r["label"]: r["share"] for r in judged.groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] >= 0.99 and share[0] <= 0.05


# ------------------------------------------------------- tokenizer alignment


def plain_tokens(text):
    """Ids and bytes of both sides by the plain libraries; none where the bytes differ."""
    left, right = o12.side(o12.ByteLevel, BYTES), o12.side(o12.Pieces, PIECES)
    if not text:
        return [], []
    a = left.tokenizer.encode(f" {text}", add_special_tokens=False).ids
    b = right.model.encode(text)
    x, y = ([(i, s.surface[i].as_py()) for i in ids] for s, ids in ((left, a), (right, b)))
    whole = f" {text}".encode()
    if any(b"".join(s for _, s in side) != whole for side in (x, y)):
        return [], []
    return x, y


def plain_alignment(texts):
    def spans(tokens):
        at, out = 0, []
        for i, s in tokens:
            out.append((at, at + len(s), i))
            at += len(s)
        return out

    found = []
    for text in texts:
        a, b = map(spans, plain_tokens(text))
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = [
            ",".join(str(x[2]) for x in a if lo < x[1] <= hi) + "|" + ",".join(str(y[2]) for y in b if lo < y[1] <= hi)
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        found.append((len(a), len(b), links, groups))
    counts = Counter(pair for *_, links, _ in found for pair in set(links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[p] == best[p[0]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, links, groups in found
    ]


def ragged(n):
    r = random.Random(9)
    some = [*" abcdefghthe.,!?'\n\t▁éß漢字😀\x00\x85\x1c 　", "  ", "   ", " the", "in", "ing", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "'s", "'ll 12", " 34"]
    return ["", " ", "a", " a ", "word " * 30, *("".join(r.choice(some) for _ in range(r.randrange(1, 40))) for _ in range(n))]


def test_ids_from_kept_parts_equal_the_libraries():
    for kind, path, encode in (
        (o12.ByteLevel, BYTES, lambda s, t: s.tokenizer.encode(f" {t}", add_special_tokens=False).ids),
        (o12.Pieces, PIECES, lambda s, t: s.model.encode(t)),
    ):
        own = kind(path)
        texts = [t for t in ragged(800) if t]
        cut = [o12._LONE_SPACE.split(t) for t in texts]
        assert own.encode(cut).to_pylist() == [encode(own, t) for t in texts]
        assert own.encode(cut).to_pylist() == [encode(own, t) for t in texts]


def test_two_generations_of_parts(monkeypatch):
    monkeypatch.setattr(o12, "ROOM", 50)
    own = o12.ByteLevel(BYTES)
    for t in ["the river runs", "stone by stone", "the river again and again", "the river runs"] * 2:
        assert own.encode([t.split(" ")]).to_pylist() == [own.tokenizer.encode(f" {t}", add_special_tokens=False).ids]


def test_aligns_the_awkward_table(spark, monkeypatch):
    texts = [(r[0], r[1]) for r in cases.rows() if r[0] != 5] + [(100 + i, t) for i, t in enumerate(ragged(80))]
    docs = spark.createDataFrame([(*x, 1, 2, "n") for x in texts], "doc_id long, text string, run long, n_a long, ids string")
    got = [tuple(r) for r in o12.link_report(docs.repartition(3), BYTES, PIECES).collect()]
    want = [(k, *x) for (k, _), x in zip(texts, plain_alignment([t for _, t in texts]), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert o12.link_report(docs.limit(0), BYTES, PIECES).count() == 0


def test_runs_of_one_text_count_like_one_run(spark, monkeypatch):
    texts = [cases.sentence(i, 40) for i in range(12)] + ["same text here"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in o12.link_report(docs, BYTES, PIECES).collect())
    assert got == [(i, *x) for i, x in enumerate(plain_alignment(texts))]


def test_groups_cover_the_tokens_in_order(spark):
    docs = spark.createDataFrame([(1, "the naïve river 漢字"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["groups"] for r in o12.aligned_groups(docs, BYTES, PIECES).collect()}
    a, b = plain_tokens("the naïve river 漢字")
    assert [i for g in got[1] for i in g["a"]] == [i for i, _ in a]
    assert [i for g in got[1] for i in g["b"]] == [i for i, _ in b]
    assert got[2] == []


# ------------------------------------------------------------- periodic runs


def plain_runs(w):
    """All periods tried one by one; of several periods of one stretch the least."""
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        t = 0
        while t < n - q:
            if w[t] != w[t + q]:
                t += 1
                continue
            s = t
            while t < n - q and w[t] == w[t + q]:
                t += 1
            if t - s + q >= max(24, 3 * q):
                found.setdefault((s, t - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_all_periods(seed):
    r = random.Random(seed)
    for _ in range(120):
        w = []
        for _ in range(r.randrange(1, 6)):
            base = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randrange(1, 25))]
            if r.random() < 0.4:
                base = [0] * r.randrange(1, 20) + base
            w += base * r.randrange(1, 9) + base[: r.randrange(len(base) + 1)]
        w = w[:400]
        assert [tuple(x) for x in o13.find_runs(np.array(w, np.int64)).tolist()] == plain_runs(w)


def test_fibonacci_and_square_words():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    assert [tuple(x) for x in o13.find_runs(np.array(b)).tolist()] == plain_runs(b)
    thue = [bin(i).count("1") % 2 for i in range(512)]
    assert len(o13.find_runs(np.array(thue))) == 0
    assert o13.find_runs(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]


def test_suffix_array_and_wavelet_queries():
    r = np.random.default_rng(3)
    words = r.integers(0, 2, 60)
    array = o13.SuffixArray(words, 6)
    assert array.order.tolist() == sorted(range(60), key=lambda i: words[i:].tolist())
    tree = o13.WaveletTree(array.order)
    for _ in range(200):
        lo, hi = sorted(r.integers(0, 61, 2))
        v = int(r.integers(0, 61))
        part = sorted(array.order[lo:hi].tolist())
        one = lambda x: np.array([x])
        assert tree.below(one(lo), one(hi), one(v))[0] == sum(x < v for x in part)
        if part:
            nth = int(r.integers(0, len(part)))
            assert tree.ranked(one(lo), one(hi), one(nth))[0] == part[nth]


def plain_digest(key, text):
    w = [x.encode() for x in cases.words(text)]
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    return (
        key,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest(),
    )


def test_digests_of_the_awkward_table_and_planted_repeats(spark):
    rows = [(r[0], r[1]) for r in cases.rows() if r[0] != 5]
    rows += [(k, cases.sentence(k, 5 + k % 150)) for k in range(200, 500)]
    rows += [(k, f"x{k} " + "ab cd ef " * 12 + "end " + "ab cd ef " * 9) for k in range(3)]
    docs = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id long, text string, start long, runs string")
    got = [tuple(r) for r in o13.run_digests(docs).collect()]
    want = [plain_digest(*x) for x in rows]
    assert sorted(got, key=str) == sorted(want, key=str) and any(x[1] for x in want)
    assert o13.run_digests(docs.limit(0)).count() == 0


def test_words_that_hash_alike_are_told_apart(spark):
    """65,536-byte blocks in another order have the same word hash; they are not the same word."""
    a, b = "a" * 65536, "b" * 65536
    texts = [" ".join([a + b, b + a] * 14 + [a + b]), " ".join(random.Random(1).choice([a + b, b + a]) for _ in range(30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in o13.periodic_runs(docs).collect()}
    assert got == {i: plain_runs(t.split()) for i, t in enumerate(texts)}


def test_collapse_leaves_texts_without_runs_alone(spark):
    texts = [(1, "a  b\n c"), (2, None), (3, "p q r " * 10 + "tail"), (4, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in o13.collapse_runs(docs).collect()}
    assert got == {1: "a  b\n c", 2: None, 3: "p q r tail", 4: ""}
