"""Crowds of near copies, and what the n-gram join sends."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from sievework.llm import ngram_join as nj
from tests.llm.test_joins import SCHEMA, brute_links, brute_pairs, corpus, expanded


def crowded(seed, copies=24, words=90):
    r = random.Random(seed)
    texts = []
    for k in range(3):
        base = [f"b{k}x{i}" for i in range(words)]
        texts += [" ".join(w if r.random() > 0.04 else f"e{r.randrange(50)}" for w in base) for _ in range(copies)]
    texts.append(" ".join([f"b0x{i}" for i in range(words)] + [f"b1x{i}" for i in range(words)]))  # like sets of two crowds
    return corpus(seed) + [(1000 + i, t, "x", "y", 1) for i, t in enumerate([*texts, texts[0], texts[0]])]


@pytest.mark.parametrize(("seed", "p"), [(1, {"crowd_min": 4}), (2, {"crowd_min": 3, "crowd_block": 5}), (3, {"crowd_min": 2, "crowd_grams": 200, "split": 4}), (4, {"crowd_min": 4, "crowd_max": 30}), (5, {"crowd_min": 2, "crowd_block": 1, "group_pairs": 3})])
def test_crowds_lose_no_link(spark, seed, p):
    rows = crowded(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    p = nj.JoinParams(**p)
    assert expanded(nj.similar(df, p)) == brute_pairs(rows, p.t)
    assert {tuple(r) for r in nj.document_links(df, p).collect()} == brute_links(rows, p.t)
    assert {r["doc_id"] for r in nj.dropped(df, p).collect()} == {i for i, root, _ in brute_links(rows, p.t) if i != root}


def test_every_set_of_a_large_cluster_is_in_one_crowd_whose_pairs_are_no_candidates(spark, monkeypatch):
    pairs = []
    real = nj._grouped
    monkeypatch.setattr(nj, "_grouped", lambda cand, cells, *a: pairs.append((cand.selectExpr("coalesce(sum(size(ibs)), 0)").first()[0], cells.count())) or real(cand, cells, *a))
    rows = [(i, t, "x", "y", 1) for i, (_, t, *_) in enumerate(x for x in crowded(6, 60) if x[0] is not None and 1000 <= x[0] < 1180)]
    got = nj.document_links(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in got.collect()} == brute_links(rows, 0.51)
    assert pairs[0][0] < 100 and 170 < pairs[0][1] <= 180  # 5,310 pairs


def test_the_pipeline_drops_a_large_cluster_without_candidates_of_its_pairs(spark, monkeypatch):
    pairs = []
    real = nj._grouped
    monkeypatch.setattr(nj, "_grouped", lambda cand, *a: pairs.append(cand.selectExpr("coalesce(sum(size(ibs)), 0)").first()[0]) or real(cand, *a))
    rows = [(i, t, "en", "src0", len(t)) for i, (_, t, *_) in enumerate(x for x in crowded(7, 60) if x[0] is not None and 1000 <= x[0] < 1180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {root for _, root, _ in brute_links(rows, 0.51)}
    assert pairs[0] < 100  # of 5,310 pairs


@pytest.mark.parametrize("targets", [50, 3000])
def test_a_posting_has_few_bytes_however_many_reducers(targets):
    class Docs:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    r = random.Random(1)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(600)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], names=["doc_id", "text"])
    p = nj.JoinParams()
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int32))
    rows = pa.Table.from_batches(nj.postings(Docs(), p, none, 60, list(range(targets)))(iter([batch])))
    n = sum(len(x.as_py()) for x in rows["pos"]) // 2
    assert n == 400 * p.prefix(598) and sum(len(x.as_py()) for c in rows.column_names[2:] for x in rows[c]) < 17 * n  # 26 bytes before at 3,000


def test_codes():
    for size in [1, 7, 4095, 4096, 4097, 8191, 8192, 10**6 + 1, 2**24 - 1, 2**26 + 3]:
        for sig in (-(2**63), -1, 0, 2**63 - 1):
            c = np.array([nj.code(sig, size)], dtype=np.int64)
            assert int(c[0]) >> 16 == sig >> 16 and size <= int(nj._sizes(c)[0]) <= size * (1 + 2**-11)
