"""Each stage against a plain form of its rule, on the awkward table and on the smallest documents."""

import re

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline as cp
from glyphledger.llm.op07_simhash import simhash
from glyphledger.session import materialize
from tests.llm import cases
from tests.llm.test_vectors_and_simhash import reach

SF = "/root/testdata/sf0.001"


def plain_near(rows):
    """Ids that stay: the least of each group."""
    fps = np.array([simhash(t) for _, t in rows], np.uint64)
    label = reach(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    least = {}
    for (key, _), x in zip(rows, label.tolist(), strict=True):
        least[x] = min(key, least.get(x, key))
    return set(least.values())


def plain_mask(text):
    for kind, pattern, good in cases.BASE:
        text = re.sub(pattern, lambda m, k=kind, g=good: f"[{k.upper()}]" if g(m[0]) else m[0], text)
    return re.sub(r'(?<=token = ")[0-9a-f]{40}(?=")', "[SECRET]", text)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = materialize(stage(spark, docs, SF))
        if name != "packing":
            assert docs.columns == cp.COLUMNS
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "language":
            assert kept[name] == before
        elif name == "near_duplicates":
            assert kept[name].keys() == plain_near(sorted(before.items()))
        elif name == "passages":
            ids = sorted(before)
            want = cases.uncovered([before[i] for i in ids], 35)
            assert kept[name].keys() == before.keys()
            assert [cases.words(kept[name][i]) for i in ids] == want
        elif name == "personal_data":
            assert {i: plain_mask(t) for i, t in before.items()} == kept[name]
        else:
            rows = docs.collect()
            assert {r["doc_id"] for r in rows} == before.keys()
            full = cases.best_fit([r["length"] for r in rows], 2048)
            assert len({r["sequence_id"] for r in rows}) == full
    whole = cp.run(spark, SF)
    place = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(place, whole.collect())) == sorted(map(place, docs.collect()))


def test_stages_take_awkward_rows_and_none(spark):
    for some in (None, []):
        docs = cases.table(spark, some)
        for _, stage in cp.STAGES:
            one = stage(spark, docs, SF)
            assert one.count() >= 0
        for _, stage in cp.STAGES:
            docs = materialize(stage(spark, docs, SF))
        assert docs.count() == 0 or {r["doc_id"] for r in docs.collect()} == {1, 5, 6, 7, 8, 10, 11, 12, None}


def test_queries_are_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
