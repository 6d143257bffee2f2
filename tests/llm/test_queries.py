"""Queries against their SQL twins, search by brute force, and the pipeline."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from pricetide.llm import topk
from pricetide.llm.common import documents
from pricetide.llm.queries import QUERIES, TWINS
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), TWINS[name]) is None


#: Queries over ``embeddings``; tests/llm/test_vectors.py has theirs.
OF_VECTORS = {"op11_nearest_by_collisions", "op12_whitening"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS) - OF_VECTORS))
def test_query_covers_its_table(spark, name):
    got = {r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()}
    assert got == {r.doc_id for r in documents(spark, SF_DIR).select("doc_id").collect()}


def brute_search(rows, k, every):
    import math

    usable = []
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(64 * x) for x in vector]
        usable.append((vec_id, whole))
    out = []
    for at, (q, asked) in enumerate(usable):
        if q % every == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(asked, v)), i)
                for n, (i, v) in enumerate(usable)
                if n != at and len(v) == len(asked)
            )
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("block", [7, 2048])
def test_search_with_ties_copies_and_unusable_vectors(spark, block):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(6)]) for k in range(300)]
    rows += [(1000 + k, rows[4][1]) for k in range(80)]
    rows += [(2000, None), (2020, []), (2040, [1.0, None] * 3), (2060, [float("nan")] * 6), (None, rows[1][1])]
    rows += [(2080, [float("inf")] * 6), rows[20], (20, rows[21][1]), (4000, [0.5, 0.5]), (4020, [0.1, 2.0])]
    rows += [(4040, [0.0] * 6)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label string")
    rules = topk.TopKRules(block=block, together=4, pivots=9)
    got = topk.search(table.repartition(4), rules).collect()
    assert sorted(map(tuple, got)) == sorted(brute_search(rows, 20, 20))
    assert topk.search(table.where("false")).count() == 0


def test_pipeline(spark):
    documents_of = documents(spark, SF_DIR)
    docs, kept = documents_of, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == documents_of.columns
        kept[name] = docs.collect()
    # Every document of the tables has a language, and each group keeps its first one.
    assert len(kept["language_id"]) == documents_of.count()
    components = QUERIES["op7_simhash_near_dedup"](spark, SF_DIR).select("component_id").distinct().collect()
    assert {r.doc_id for r in kept["near_dedup"]} == {r.component_id for r in components}
    assert len(kept["near_dedup"]) == len(components) == len(kept["secret_scan"])
    assert all(r.n_chars == len(r.text) for r in kept["secret_scan"])
    before = {r.doc_id: r.text for r in kept["near_dedup"]}
    changed = {r.doc_id for r in kept["secret_scan"] if r.text != before[r.doc_id]}
    spans = QUERIES["op1_secret_scan"](spark, SF_DIR).where("spans <> ''").select("doc_id").collect()
    assert changed == {r.doc_id for r in spans} & set(before)
    mixed = Counter(r.doc_id for r in kept["source_mix"])
    assert max(mixed.values()) == 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(mixed)


def test_pipeline_of_nothing(spark):
    docs = documents(spark, SF_DIR).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.count() == 0
