import numpy as np
import pytest
import xxhash

from glyphledger.llm import op01_embeddings as o1
from glyphledger.llm import op07_simhash as o7
from glyphledger.llm.components import components
from tests.llm import cases


def reach(near):
    label = np.arange(len(near))
    while True:
        new = np.array([min(label[near[i]].min(initial=label[i]), label[i]) for i in range(len(near))])
        if (new == label).all():
            return label
        label = new


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(40)] + [(900, 900), (None, 3), (7, 6), (6, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {500 + i: 500 for i in range(40)}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def bit_votes(text):
    w = [x.encode().lower() for x in cases.words(text)]
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " ", "one", "One TWO", "a b c", cases.sentence(9, 300), "É é straße " * 9])
def test_fingerprint_is_the_majority_of_bits(text):
    assert o7.simhash(text) == bit_votes(text)


def test_forest_connects_what_links_connect():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 12)
    flips = np.array([sum(1 << int(b) for b in r.integers(0, 63, 2)) for _ in range(200)])
    values = np.unique(np.concatenate([base, base[r.integers(0, 12, 200)] ^ flips]))
    want = reach(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    for cut in (0, 70):
        a, b = (values, values) if not cut else (values[:cut], values[cut:])
        label = {int(v): int(v) for v in values}
        parts = [(a, a), (a, b), (b, b)] if cut else [(a, a)]
        edges = [e for x, y in parts for e in zip(*o7.forest(x, x if x is y else y), strict=True)]
        assert len(edges) <= sum(len(x) + (len(y) if x is not y else 0) for x, y in parts)

        def root(v):
            while label[v] != v:
                v = label[v]
            return v

        for u, v in edges:
            x, y = root(int(u)), root(int(v))
            label[max(x, y)] = min(x, y)
        got = [root(int(v)) for v in values]
        assert len(set(zip(got, want.tolist(), strict=True))) == len(set(got)) == len(set(want.tolist()))


@pytest.mark.parametrize("size", [3, 8192])
def test_tiles_lose_no_link(spark, monkeypatch, size):
    r = np.random.default_rng(size)
    base = r.integers(-(2**63), 2**63, 20)
    near = base[r.integers(0, 20, 150)] ^ np.array([1 << int(b) for b in r.integers(0, 62, 150)])
    values = np.unique(np.concatenate([base, near, [0]]))
    frame = spark.createDataFrame([(int(v),) for v in values], "fp long")
    found = components(o7.links(o7.pack_tiles(frame, size)))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = reach(np.bitwise_count(values.view(np.uint64)[:, None] ^ values.view(np.uint64)[None, :]) <= 3)
    assert [got.get(int(v), int(v)) for v in values] == [int(values[w]) for w in want]


def test_groups_of_the_awkward_table(spark):
    docs = cases.table(spark)
    got = o7.near_groups(docs).collect()
    keys = [r[0] for r in cases.rows()]
    fps = np.array([o7.simhash(r[1]) for r in cases.rows()], np.uint64)
    label = reach(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    want = []
    for i, key in enumerate(keys):
        mates = [k for k, x in zip(keys, label, strict=True) if x == label[i] and k is not None]
        want.append((key, int(fps[i : i + 1].view(np.int64)[0]), min(mates, default=None)))
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got) == order(want)
    kept = o7.near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({w[2] for w in want if w[2] is not None})
    assert ids.count(None) == 2
    assert o7.near_duplicates(docs.limit(0)).count() == 0


def vectors():
    r = np.random.default_rng(8)
    out = r.standard_normal((60, 16))
    near = out[r.integers(0, 6, 60)] + 0.08 * r.standard_normal((60, 16))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([out, near]))]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, [2 * x for x in rows[3][1]])]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [float("inf")] * 16)]
    rows += [(305, [1.0, None]), (306, [1.0, 0.0]), (307, [2.0, 0.0]), (308, [1.0, 0.0, 0.0]), (308, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])]
    return rows


def test_near_vectors_equal_all_pairs(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, id string")
    got = sorted(map(tuple, o1.near_vectors(table).collect()), key=str)

    def good(v):
        return v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)

    n = len(rows)
    near = np.zeros((n, n), bool)
    for i, (a, v) in enumerate(rows):
        for j, (b, w) in enumerate(rows):
            if i != j and a is not None and b is not None and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                near[i, j] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9
    label = reach(near)
    want = []
    for i, (a, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(n) if label[j] == label[i]]
        least = a if a is None else min(mates)
        want.append((a, int(near[i].sum()), least, a is not None and a == least))
    assert got == sorted(want, key=str)


def test_large_filters_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(o1, "CHUNK", 7)
    r = np.random.default_rng(2)
    v = np.ones(8) + 0.05 * r.standard_normal((40, 8))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {x["vec_id"]: x for x in o1.near_vectors(table).collect()}
    assert all(got[i]["n_links"] == 39 and got[i]["component_id"] == 0 for i in range(40))


def test_no_vectors(spark):
    assert o1.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize(("cosine", "least"), [(0.9, 0.95), (0.95, 0.99), (0.99, 0.999)])
def test_recall_of_the_filters(cosine, least):
    r = np.random.default_rng(5)
    a = o1.unit(r.standard_normal((1500, 64)))
    n = r.standard_normal((1500, 64))
    n = o1.unit(n - (n * a).sum(1)[:, None] * a)
    found = o1.passed_filters(np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * n]))
    hits = [bool(len(np.intersect1d(found[i], found[i + 1500]))) for i in range(1500)]
    assert np.mean(hits) >= least


@pytest.mark.parametrize("order", [1, -1])
def test_rows_of_one_key_with_unlike_texts_are_judged_apart(spark, order):
    a, b = cases.sentence(40, 80), cases.sentence(41, 80)
    rows = [(0, a, "x"), (1, a, "y"), (1, b, "z"), (None, a, "n"), (None, cases.sentence(42, 80), "m"), (3, b, "w"), (3, b, "v")]
    docs = spark.createDataFrame(rows[::order], "doc_id long, text string, digest string").repartition(3)
    kept = sorted((tuple(r) for r in o7.near_duplicates(docs).collect()), key=str)
    assert kept == sorted([(0, a, "x"), (1, b, "z"), (None, a, "n"), (None, cases.sentence(42, 80), "m")], key=str)


@pytest.mark.parametrize("order", [1, -1])
def test_a_repeated_key_with_other_vectors_is_another_vector(spark, order):
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (7, [1.0, 0.01, 0.0]), (9, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows[::order], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in o1.near_vectors(table).collect())
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 1, 5, False)]
