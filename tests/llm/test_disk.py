"""What the n-gram join and the pipeline's second stage leave on disk and send."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import ngram_join as nj
from tests.llm.test_crowds import crowded
from tests.llm.test_joins import SCHEMA, brute_links

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*.data")}


def test_the_join_leaves_no_shuffle_files(spark):
    docs = spark.createDataFrame(crowded(8), SCHEMA).repartition(3)
    before, setting = shuffle_files(spark), spark.conf.get(nj._CLEANUP)
    nj.similar(docs)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(nj._CLEANUP) == setting


def test_the_second_stage_sends_few_texts(spark):
    r = random.Random(1)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(300)) for _ in range(800)]
    rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate([*texts, *texts[:5], texts[7] + " and more"])] + [(None, texts[0], "en", "src0", 1), (9000, None, "en", "src0", 0)]
    docs = spark.createDataFrame(rows, COLUMNS)
    files = shuffle_files(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(kept, key=str) == sorted([None, 9000, *range(800)], key=str)
    assert sum(p.stat().st_size for p in shuffle_files(spark) - files) < sum(map(len, texts)) / 20


@pytest.mark.parametrize("bits", [12, 26])
def test_a_bitmap_of_ids_misses_none(spark, bits):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "v")
    got = spark.range(3000).selectExpr("id", "if(id = 2999, null, id) AS c").withColumn("may", nj.among(ids, "v", nj.JoinParams(id_bits=bits))(F.col("c"))).collect()
    assert all(r["may"] for r in got if r["id"] % 3 == 0) and got[2999]["may"] is None
    assert sum(bool(r["may"]) for r in got if r["id"] % 3) < (600 if bits == 12 else 200)


def test_grams_that_come_too_late_for_a_pair_are_no_meeting():
    p, none = nj.JoinParams(), np.full(2, -1)

    def meets(pos, sizes=(100, 100)):
        pairs = nj._scan(np.full(2, 77 << 24, np.uint64), np.arange(2), np.array(sizes), np.array(pos, np.uint16), none, p, 2)
        return sum(len(a) for a, *_ in pairs)

    assert meets((5, 5)) == meets((35, 35)) == 1  # 68 in common, 4 of them within 100 - 68 + 4
    assert meets((37, 37)) == meets((45, 45)) == 0  # sent for the sake of smaller sets
    assert meets((5, 45), (60, 100)) == 1  # 54 in common


@pytest.mark.parametrize(("sets", "pairs"), [(2, 1), (300, 5000), (6000, 5000)])
def test_pairs_that_met_come_back_and_take_few_bytes(sets, pairs):
    r = np.random.default_rng(1)
    codes = np.unique(np.concatenate((r.integers(-(2**63), 2**63 - 1, sets), [-(2**63), 2**63 - 1])))
    i = np.unique(np.sort(r.integers(0, len(codes), (2, pairs)), axis=0), axis=1)
    i = i[:, i[0] != i[1]]
    n = r.integers(1, 4, i.shape[1]).astype(np.uint16)
    told = nj._told(codes[i[0]], codes[i[1]], n)
    got = nj._heard(*(c[0].as_py() for c in told.columns))
    assert all((x == y).all() for x, y in zip(got, (codes[i[0]], codes[i[1]], n)))
    if pairs > 1:
        assert sum(len(c[0].as_py()) for c in told.columns) < 10 * i.shape[1] + 8 * min(sets, 300)  # places of 4 bytes and 8 for each set before


def test_the_pipeline_keeps_one_of_each_group_with_few_bits(spark):
    rows = [(i, t, "en", "src0", len(t)) for i, (_, t, *_) in enumerate(x for x in crowded(9) if x[0] is not None and x[0] >= 1000)]
    kept = {r["doc_id"] for r in nj.one_of_each_group(spark.createDataFrame(rows, COLUMNS), nj.JoinParams(id_bits=6)).collect()}
    assert kept == {root for _, root, _ in brute_links(rows, 0.51)}
