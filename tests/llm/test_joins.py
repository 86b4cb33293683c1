"""The n-gram join, repeated passages and top-k against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import ngram_join as nj
from sievework.llm import substrings, topk

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, sig string, size string, `key` int"


def corpus(seed: int, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["é", "naïve"]
    texts: list = [None, "", " ,. ", "one", "one", "two words", "Two, words"]
    base = [[r.choice(vocab) for _ in range(r.choice([4, 8, 20, 60, 150]))] for _ in range(n // 4)]
    for b in base:
        texts.append(" ".join(b))
        for _ in range(r.choice([0, 1, 3])):
            c = [w if r.random() > 0.05 else r.choice(vocab) for w in b]
            texts.append((" ".join(c) + r.choice(["", ".", " !"])).upper() if r.random() < 0.2 else " ".join(c))
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, texts[9], "x", "y", 1)]


def grams_of(text, n=3):
    w = WORD.findall(text.lower()) if text else []
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute_pairs(rows, t):
    sets = {r[0]: grams_of(r[1]) for r in rows if r[0] is not None}
    out = set()
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b]:
            k = len(sets[a] & sets[b])
            if k >= t * (len(sets[a]) + len(sets[b]) - k) - 1e-9:
                out.add((a, b, round(k / (len(sets[a]) + len(sets[b]) - k), 6)))
    return out


def expanded(j):
    """All pairs of documents that the classes and links of a join stand for."""
    of: dict = {}
    for r in j.sets.where("aux IS NOT NULL").collect():
        of.setdefault((r["sig"], r["aux"]), []).append(r["doc_id"])
    mine = {min(v): sorted(v) for v in of.values()}
    out = {(a, b, 1.0) for v in mine.values() for a, b in combinations(v, 2)}
    for r in j.pairs.collect():
        assert (r["nx"], r["ny"]) == (len(mine[r["x"]]), len(mine[r["y"]]))
        out |= {(min(a, b), max(a, b), round(r["jaccard"], 6)) for a in mine[r["x"]] for b in mine[r["y"]]}
    return out


def brute_links(rows, t):
    """(doc_id, least connected doc_id, similar documents) of each document."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    parent, degree = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, _ in brute_pairs(rows, t):
        degree[a] += 1
        degree[b] += 1
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {(i, root(i), degree[i]) for i in ids}


@pytest.mark.parametrize(("seed", "t", "lead"), [(1, 0.6, 0.1), (2, 0.51, 0.1), (3, 0.8, 0.02), (4, 0.55, 0.2)])
def test_pairs_are_those_of_brute_force(spark, seed, t, lead):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    p = nj.JoinParams(t=t, lead=lead)
    got = expanded(nj.similar(df, p))
    assert got == brute_pairs(rows, t) and got
    assert {tuple(r) for r in nj.document_links(df, p).collect()} == brute_links(rows, t)


@pytest.mark.parametrize("x", [2, 20, 500])
def test_any_boundary_and_any_split_give_the_same(spark, monkeypatch, x):
    rows = corpus(7)
    monkeypatch.setattr(nj, "boundary", lambda *a: x)
    j = nj.similar(spark.createDataFrame(rows, SCHEMA), nj.JoinParams(t=0.6, split=2, group_pairs=3))
    assert {p[:2] for p in expanded(j)} == {p[:2] for p in brute_pairs(rows, 0.6)}


def test_the_tree_connects_what_all_pairs_do(spark):
    j = nj.similar(spark.createDataFrame(corpus(8), SCHEMA), nj.JoinParams(group_pairs=4))
    roots = [{tuple(r) for r in nj.components(x.select("x", "y")).collect()} for x in (j.pairs, j.pairs.where("tree"))]
    assert roots[0] == roots[1] and roots[0]


def test_the_boundary_is_that_of_least_cost():
    p = nj.JoinParams()
    assert nj.boundary(p, {}, 0) == 2
    assert nj.boundary(p, {300: (1000, 10**12)}, 5) == 301  # lists that nobody could scan
    assert nj.boundary(p, {4: (10**6, 10**9), 3000: (10**6, 10**6)}, 5) == 3000
    assert nj.boundary(p, {3000: (10**6, 10**6)}, 5) in (2, 3000)
    s = np.array([1, 2, 255, 256, 257, 1000, 10**6])
    assert list(nj.size_class(s)) == [1, 2, 255, 256, 256, 992, 983040]


def test_one_of_each_group_stays(spark):
    rows = corpus(5)
    kept = nj.one_of_each_group(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "sig", "size", "key"]
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, _ in brute_pairs(rows, nj.JoinParams().t):
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = sorted({root(i) for i in parent}) + [None]
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda v: (v is None, v)) == want


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nj.document_links(empty).count() == 0
    assert nj.one_of_each_group(empty).count() == 0
    assert substrings.repeated_spans(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {(r["v"], r["root"]) for r in nj.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(101, 100), (103, 100)}


def brute_spans(rows, base):
    words = {r[0]: WORD.findall(r[1].lower()) for r in rows if r[0] is not None and r[1]}
    spans, length = {}, base
    while True:
        where: dict = {}
        for d, w in words.items():
            for p in range(len(w) - length + 1):
                where.setdefault(tuple(w[p : p + length]), []).append((d, p))
        hit = {x for v in where.values() if len({d for d, _ in v}) > 1 for x in v}
        if not hit:
            break
        for x in hit:
            spans[x] = length
        length *= 2
    out = []
    for d, p in sorted(spans):
        if out and out[-1][0] == d and p <= out[-1][2]:
            out[-1][2], out[-1][3] = p + base, max(out[-1][3], spans[d, p])
        else:
            out.append([d, p, p + base, spans[d, p]])
    return {tuple(x) for x in out}


@pytest.mark.parametrize("bits", [27, 6])
def test_repeated_spans_are_those_of_brute_force(spark, bits):
    r = random.Random(3)
    words = lambda n: [f"v{r.randrange(400)}" for _ in range(n)]
    shared = [words(n) for n in (6, 9, 14, 30)]
    texts = [" ".join(words(r.randrange(30)) + r.choice(shared) + words(r.randrange(20)) + r.choice([[], shared[1]])) for _ in range(40)]
    twice = "q1 q2 q3 q4 q5 q6 q7 " * 3  # repeats within one document only
    rows = [(i, t, "", "", 0) for i, t in enumerate([*texts, twice, None, "", "short", texts[0]])]
    rows += [rows[2], (None, texts[0], "", "", 0), (99, " ".join(words(40)), "", "", 0), (99, rows[3][1], "", "", 0)][:3]
    got = substrings.repeated_spans(spark.createDataFrame(rows, SCHEMA).repartition(3), 8, bits)
    assert {(x["doc_id"], x["start_word"], x["end_word"], x["longest"]) for x in got.collect()} == brute_spans(rows, 8)


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 99, 50)
    for n in (1, 2, 3, 7, 26, 50):
        assert list(substrings.sliding_min(x, n)) == [x[i : i + n].min() for i in range(50 - n + 1)]
    assert len(substrings.sliding_min(x, 51)) == 0


@pytest.mark.parametrize(("rows_in_block", "scale", "every"), [(16, 1.0, 1), (4096, 1.0, 1), (24, 1e6, 3)])
def test_top_k_is_exact(spark, rows_in_block, scale, every):
    g = np.random.default_rng(1)
    x = (np.concatenate([g.normal(c, 0.1, (40, 5)) for c in (0, 3, 9)]) * scale).astype(np.float32)
    x[7] = x[8] = x[30]
    data = [(i, [float(e) for e in v], "z") for i, v in enumerate(x)]
    bad = [(None, data[0][1], "z"), (500, None, "z"), (501, [1.0], "z"), (502, [float("nan")] * 5, "z"), (503, [1.0, None, 1.0, 1.0, 1.0], "z"), (504, [], "z"), data[3]]
    df = spark.createDataFrame([*data, *bad], "vec_id long, embedding array<float>, block string")
    got = topk.nearest(df, asks=F.col("id") % every == 0, p=topk.TopKParams(k=4, pivots=6, block_rows=rows_in_block, group=8)).collect()
    d = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(2)).round(9)
    want = {(i, j, k + 1) for i in range(0, len(x), every) for k, j in enumerate(sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[i, j], j))[:4])}
    assert {(r["id"], r["neighbour"], r["rank"]) for r in got} == want and len(got) == len(want)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 3.0])], "vec_id long, embedding array<float>")
    assert sorted((r["id"], r["neighbour"], r["distance"]) for r in topk.nearest(df).collect()) == [(1, 2, 2.0), (2, 1, 2.0)]
    assert topk.nearest(df.limit(0)).count() == 0
    assert topk.nearest(df, asks=F.col("id") > 5).count() == 0


def test_pivots_eliminate_on_clustered_vectors():
    g = np.random.default_rng(2)
    x = np.concatenate([g.normal(c, 0.05, (200, 8)) for c in range(10)])
    d = topk.pivot_distances(x, x[::200]).astype(np.float32)
    s = topk.Search(np.arange(len(x)), x, d, 5)
    s.visit(np.arange(len(x)), x, d)
    assert s.evaluated < 0.2 * len(x) ** 2


def test_very_long_texts(spark):
    r = random.Random(9)
    w = [f"x{r.randrange(5000)}" for _ in range(120_000)]
    copy = [v if i % 40 else "edited" for i, v in enumerate(w)]
    other = [f"y{r.randrange(5000)}" for _ in range(60_000)]
    df = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(copy)), (3, " ".join(other)), (4, "x1")], "doc_id long, text string")
    assert {tuple(x) for x in nj.document_links(df).collect()} == {(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0)}
    spans = substrings.repeated_spans(df.where("doc_id <> 2").union(df.where("doc_id = 1").selectExpr("9", "text")), 50).collect()
    assert sorted((s["doc_id"], s["start_word"], s["end_word"], s["longest"]) for s in spans) == [(1, 0, 120_000, 102_400), (9, 0, 120_000, 102_400)]
