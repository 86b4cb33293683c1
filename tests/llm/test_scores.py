"""Classifiers on held-out labels, quality measures and licence scans against plain Python."""

import random

import numpy as np

from sievework.llm import licenses, quality, toxicity, urls

R = random.Random(2)
NEUTRAL = [f"n{i}" for i in range(200)]


def words():
    return [R.choice(["lamp", "river", "stone", "green", "walk", "table", "cloud", "paper"]) for _ in range(30)]


def toxic_rows(n=400):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        group = ["muslims"] if (i % 4 == 0 and i % 8 == 0) or i % 40 == 1 else []
        w = words() + (["vermin", "scum"] if bad else []) + group
        R.shuffle(w)
        docs.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxic_words_are_learnt_and_groups_are_not(spark):
    docs, labels = toxic_rows()
    d = spark.createDataFrame([*docs, (900, None, "s"), (901, "", "s"), docs[1]], "doc_id long, text string, score string")
    y = spark.createDataFrame([*labels[:300], (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    kept = toxicity.reject_toxic(d, y)
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {900, 901} <= set(ids) and ids.count(1) == 2
    held_out = [(i, bad) for i, _, bad in labels[300:]]
    assert all((i not in ids) == bool(bad) for i, bad in held_out)
    plain, fair = toxicity.train(d, y, cf=0.0), toxicity.train(d, y, cf=5.0)
    a, b = "the muslims walk by the river", "the christians walk by the river"
    gap = lambda m: abs(m.score(a) - m.score(b))
    assert gap(fair) < 0.2 and gap(fair) <= gap(plain)


def test_without_labels_nothing_is_rejected(spark):
    d = spark.createDataFrame([(1, "x y"), (2, "z")], "doc_id long, text string")
    assert toxicity.reject_toxic(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 2


def test_js_distance():
    assert quality.js_distance(np.array([1.0, 1]), np.array([2.0, 2])) == 0
    assert abs(quality.js_distance(np.array([1.0, 0]), np.array([0.0, 1])) - 1) < 1e-12


def test_common_words_are_exact_in_any_partitioning(spark):
    texts = [" ".join(R.choice(NEUTRAL[: 3 + i % 40]) for _ in range(50)) for i in range(60)]
    rows = [(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)] + [(90, None, "en"), (91, "", "en")]
    rules = quality.QualityRules(phi=0.02, min_reference_words=1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want: dict = {}
    for _, t, lang in rows:
        for w in quality.WORD.findall(t or ""):
            want.setdefault(lang, {}).setdefault(w, 0)
            want[lang][w] += 1
    want = {g: {w: n for w, n in c.items() if n >= 0.02 * sum(c.values())} for g, c in want.items()}
    for n in (1, 5):
        refs = quality.references(df.repartition(n), rules)
        assert {g: {w: hist[i] for w, i in index.items()} for g, (_, _, index, hist) in refs.items()} == want
        assert all(hist.sum() == n_words and chars.sum() == sum(len(t or "") for _, t, lang in rows if lang == g) for g, (n_words, chars, _, hist) in refs.items())
    assert quality.references(df.limit(0), rules) == {}


def test_junk_is_far_from_its_language(spark):
    clean = [(i, ". ".join(" ".join(R.choice(["the", "of", "and", "stone", "river", "walk"]) for _ in range(12)) for _ in range(12)), "en") for i in range(40)]
    junk = [(100, "%$# @@@ 0101 " * 60, "en"), (101, "BUY NOW " * 80, "en"), (102, None, "en"), (103, "short", "en")]
    rules = quality.QualityRules(min_reference_words=10)
    df = spark.createDataFrame([*clean, *junk], "doc_id long, text string, lang string")
    refs = quality.references(df, rules)
    kept = df.select("doc_id", quality.distances(df["lang"], df["text"], refs, rules).alias("d"))
    ids = {r["doc_id"] for r in kept.where(quality.keep(kept["d"], rules)).collect()}
    assert ids == {i for i, *_ in clean} | {102, 103}


def test_licences_are_found_where_they_are():
    items = licenses.templates()
    index = licenses.build_index(100, {"license": 20, "the": 100, "under": 50}, items)
    for t in items:
        text = "some words before " + " ".join(t.words) + " and some after it"
        assert any(h[0] == t.name for h in index.find(text)), t
    for clean in (None, "", "a license to work under the apache helicopter version", "the public general software"):
        assert index.find(clean) == []
    twice = "Licensed under the MIT License. " + "word " * 50 + "Released under the MIT License."
    assert [h[0] for h in index.find(twice)] == ["MIT", "MIT"]


def test_licence_scan_of_a_table(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0", "x"), (2, None, "x"), (3, "", "x"), (1, "Licensed under the Apache License, Version 2.0", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    items = licenses.templates()
    n, df_counts = licenses.document_frequencies(df, items)
    assert n == 4
    assert [(r["doc_id"], r["license"]) for r in licenses.scan(df, licenses.build_index(n, df_counts, items)).collect()] == [(1, "Apache-2.0")] * 2


def pages(n=600):
    r = random.Random(5)
    out = []
    for i in range(n):
        bad = i % 6 == 0
        host = "-".join(r.choice(["win", "bet", "pill", "cash"]) for _ in range(2)) if bad else "".join(r.choice("aeioulnrst") for _ in range(7))
        out.append((i, f"https://{host}.example.{r.choice(['com', 'org'])}/{r.choice(['en', 'de'])}/{r.randrange(999)}?a=1", f"x{i}"))
    return out


def test_held_out_urls_are_told_apart(spark):
    rows = pages()
    odd = [(900, None, "x"), (901, "  ", "x"), (902, "no scheme/at all", "x"), rows[1]]
    df = spark.createDataFrame([*rows, *odd], "page_id long, url string, host string")
    labels = spark.createDataFrame([(u, int(i % 6 == 0)) for i, u, _ in rows[:300]] + [(None, 1), (rows[2][1], None)], "url string, label int")
    got = urls.filter_urls(df, labels).collect()
    keep = {r["page_id"]: r["keep"] for r in got}
    assert len(got) == len(rows) + 4 and keep[900] is False and keep[901] is False and keep[902] is True
    right = sum(keep[i] == (i % 6 != 0) for i, *_ in rows[300:])
    assert right >= 0.97 * 300
    assert all(r["score"] is None for r in got if r["page_id"] in (900, 901))


def test_urls_of_one_class_are_kept(spark):
    df = spark.createDataFrame([(1, "http://a.example.com/x")], "page_id long, url string")
    assert [r["keep"] for r in urls.filter_urls(df, spark.createDataFrame([], "url string, label int")).collect()] == [True]


def test_compiled_trees_score_as_the_model(spark):
    df = spark.createDataFrame(pages(200), "page_id long, url string, x string")
    split = urls.parts(df)
    feats, names = urls.features(split, urls.suffix_shares(split))
    model = urls.train(feats, names, spark.createDataFrame([(u, int(i % 6 == 0)) for i, u, _ in pages(200)], "url string, label int"), urls.UrlParams())
    rated = urls.rated(feats, model)
    got = rated.select(*model.names, urls.score(model).alias("p")).toPandas()
    want = 1 / (1 + np.exp(-model.margin(got[model.names].to_numpy(dtype=float))))
    assert np.allclose(got["p"], want)


def test_licences_are_those_of_a_search_at_every_place(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    items = licenses.templates()
    index = licenses.build_index(len(texts), {"the": 600, "of": 600, "in": 500, "this": 200, "is": 300, "and": 600, "to": 500, "license": 30}, items)
    found = 0
    for t in texts:
        got = {h[0] for h in index.find(t)}
        toks = licenses.tokens(t)
        words = set(toks)
        every = {x.name for n, x in enumerate(items) if all(w in words for p in x.phrases for w in p) and any(index.verify(toks, n, s) for s in range(-index.slack, len(toks)))}
        assert got <= every and bool(got) == bool(every), t[:200]
        found += bool(got)
    assert found > 10
