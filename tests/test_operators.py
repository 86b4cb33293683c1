"""Core functions and operators against plain Python, with the awkward cases."""

import json
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.functions import urls as U
from sievework.operators import chunking as C
from sievework.operators import classify as K
from sievework.operators import collect as L
from sievework.operators import crawl as W
from sievework.operators import ocr as O
from sievework.operators import records as M
from sievework.operators import relational as R
from sievework.operators import sampling as P
from sievework.operators import sequence
from sievework.operators import stats as S
from sievework.profiles import ChunkSizes
from sievework.sources import boundary, files
from sievework.streaming import progress


def values(spark, column, *cells, ddl="c string"):
    df = spark.createDataFrame([c if isinstance(c, tuple) else (c,) for c in cells], ddl)
    return [r[0] for r in df.select(F.monotonically_increasing_id().alias("i"), column.alias("v")).orderBy("i").select("v").collect()]


c = None


@pytest.fixture(autouse=True)
def _column(spark):
    """Columns can be made only with a session."""
    globals()["c"] = F.col("c")


def test_cp1252_is_recovered(spark):
    every = "".join(chr(x) for x in range(0x80, 0xA0))
    want = bytes(range(0x80, 0xA0)).decode("cp1252", "ignore")
    assert values(spark, T.recover_cp1252(c), every, "plain", None) == [want, "plain", None]


def test_private_use_characters(spark):
    a, p = "ب", ""
    assert values(spark, T.drop_private_use(c), a + p + a, a + p + p + a, " " + p, p) == [a + p + a, a + a, " ", ""]
    assert values(spark, T.private_use_in_words(c), a + p + a, a + p + p + a, " " + p, None) == [1, 0, 0, None]


def test_controls(spark):
    assert values(spark, T.stray_controls(c), "a\n\tb", "\r", "\x7f", "\f", None) == [0, 1, 1, 1, None]


def plain_clean(t):
    t = unicodedata.normalize("NFKC", t)
    good = {chr(x): bytes([x]).decode("cp1252", "ignore") for x in range(0x80, 0xA0)}
    t = "".join(good.get(x, x) for x in t)
    arabic = lambda x: "؀" <= x <= "ۿ"
    t = "".join(x for i, x in enumerate(t) if unicodedata.category(x) != "Co" or (0 < i < len(t) - 1 and arabic(t[i - 1]) and arabic(t[i + 1])))
    t = t.translate(str.maketrans("يكة", "یکە"))
    t = "\n".join("" if not line.strip() else line for line in t.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", t).strip() + "\n"


def test_clean_text_is_as_in_plain_python(spark):
    r = random.Random(3)
    cells = ["a\n\f\nb", "", "  x \n \n\n\n y ", "ﬁ ﻻ ①", "يك"] + ["".join(r.choice("ab \n\t\x85\x92يﺏ①.") for _ in range(40)) for _ in range(200)]
    cells = [x for x in cells if "\x85" not in unicodedata.normalize("NFKC", x)[:1]]
    assert values(spark, T.clean(c), *cells) == [plain_clean(x) for x in cells]


def test_cascade_boundaries(spark):
    cells = ["a" * 199, "a" * 200, "a" * 999, "a" * 1000, "a" * 999 + "é", "é" * 101 + "a" * 100, "é" * 100 + "a" * 100, "a" * 200 + "\r", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, text string")
    got = K.text_stats(df).withColumn("k", K.extraction_class(F.lit("extracted"))).orderBy("i").select("k.reason").collect()
    assert [r[0] for r in got] == ["too short", "clean", "clean", "other language", "clean", "other script", "clean", "stray controls", "too short"]
    status = K.extraction_status(F.col("a"), F.col("b"), F.col("e"), F.col("x"))
    rows = [(39.9, 0.0, 0.0, None), (40.0, 0.21, 0.0, None), (40.0, 0.2, 0.51, None), (40.0, 0.2, 0.5, None), (1.0, 0.0, 0.0, "bad")]
    assert values(spark, status, *rows, ddl="a double, b double, e double, x string") == ["needs_ocr", "extracted_suspect", "extracted_partial", "extracted", "error"]


def estimate(t):
    return max(1, round(len(t) / 1.6))


def plain_chunks(text, k):
    paras = [x for x in (p.strip() for page in text.split("\f") for p in page.split("\n")) if x]

    def pack(items, limit, joiner, oversize):
        done, open_, n = [], None, 0
        for x in items:
            t = estimate(x)
            if t > k.most:
                done += ([open_] if open_ is not None else []) + oversize(x)
                open_, n = None, 0
            elif open_ is not None and n + t > limit:
                done.append(open_)
                open_, n = x, t
            else:
                open_, n = x if open_ is None else open_ + joiner + x, n + t
        return done + ([open_] if open_ is not None else [])

    size = int(k.most * 1.6)
    cut = lambda s: [s[i : i + size] for i in range(0, len(s), size)]
    split = lambda p: pack([s for s in re.split(r"(?<=[.!?؟۔।])\s+", p) if s.strip()], k.most, " ", cut)
    out = []
    for x in pack(paras, k.target, "\n\n", split):
        if out and estimate(x) < k.least:
            out[-1] += "\n\n" + x
        else:
            out.append(x)
    return [x for x in out if estimate(x) >= k.least]


def test_chunks_are_those_of_a_plain_fold(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    r = random.Random(4)
    docs += ["", "thin", "x" * 3000, "a. " * 900, "\n".join("w" * r.choice([10, 200, 900]) for _ in range(40)), "one\ftwo\n\nthree"]
    k = ChunkSizes()
    assert values(spark, C.chunk_array(c, k), *docs) == [plain_chunks(t, k) for t in docs]


def test_garbled_documents_by_exact_median(spark):
    rows = [("d", "x" * 10, 10), ("d", "x" * 20, 10), ("e", "x" * 10, 10), ("e", "x" * 20, 10), ("e", "x" * 40, 10)]
    df = spark.createDataFrame(rows, "document_id string, text string, token_estimate int")
    assert [r["document_id"] for r in C.garbled(df, 1.6).collect()] == ["d"]
    assert C.gate(df, 1.6).count() == 3


def test_responses(spark):
    good = {"question": "q", "answer": "a", "question_type": "factual", "reasoning": " r "}
    cells = ["", None, "[]", "{}", "not json", "```json\n" + json.dumps([good]) + "\n```", json.dumps([good, {"question": "", "answer": "a", "question_type": "factual"}]), json.dumps([{**good, "question_type": "other"}]), json.dumps([{**good, "question": " "}])]
    got = values(spark, M.parse_response(c), *cells)
    assert [r["status"] for r in got] == ["empty", "empty", "empty", "parse_error", "parse_error", "ok", "ok", "parse_error", "ok"]
    assert got[5]["pairs"][0]["reasoning"] == "r" and len(got[6]["pairs"]) == 1


def test_user_messages_are_split_at_the_last_question(spark):
    u = ["Context: a\n\nQuestion: b\n\nQuestion: c", "Question: x", "other", None]
    got = values(spark, M.split_user(c), *u)
    assert [(r["context"], r["question"]) for r in got] == [("a\n\nQuestion: b", "c"), (None, "x"), (None, "other"), (None, None)]


def test_restore_fails_on_a_broken_record(spark):
    pair = spark.createDataFrame([("ctx", "q", "a", None, "no_context", "d", "c9", "s", "factual")], "context string, question string, answer string, reasoning string, context_mode string, document_id string, chunk_id string, source string, question_type string")
    chunks = spark.createDataFrame([("c1", "t")], "chunk_id string, text string")
    with pytest.raises(Exception, match="no chunk"):
        M.restore(M.build(pair), chunks).collect()
    whole = M.flatten(M.restore(M.build(pair), spark.createDataFrame([("c9", "t")], "chunk_id string, text string"))).first()
    assert whole["user"] == "Context: t\n\nQuestion: q" and whole["context_mode"] == "with_context"


def test_missing_chunks_by_policy(spark):
    p = spark.createDataFrame([("a",), ("b",), (None,)], "chunk_id string")
    k = spark.createDataFrame([("a", "t")], "chunk_id string, text string")
    assert R.with_context(p, k, "drop").count() == 1
    assert sorted(r["context"] for r in R.with_context(p, k, "blank").collect()) == ["", "", "t"]
    assert sum(r["missing"] for r in R.with_context(p, k, "flag").collect()) == 2
    with pytest.raises(Exception, match="no chunk b"):
        R.with_context(p.where("chunk_id = 'b'"), k, "fail").collect()


def test_first_and_last_win(spark):
    log = spark.createDataFrame([(1, 1, "error"), (1, 2, "ok"), (2, 1, "ok"), (2, 2, "ok"), (None, 3, "ok")], "k int, n int, status string")
    assert {(r["k"], r["n"]) for r in R.keep_first(log, ["k"], [F.col("n")]).collect()} == {(1, 1), (2, 1), (None, 3)}
    assert {(r["k"], r["n"]) for r in R.keep_latest(log, ["k"], [F.col("n")]).collect()} == {(1, 2), (2, 2), (None, 3)}
    assert {r["k"] for r in R.pending(spark.createDataFrame([(1,), (5,)], "k int"), log, ["k"]).collect()} == {5}


def test_duplicates_point_to_the_first(spark):
    df = spark.createDataFrame([(0, "q"), (1, "x"), (2, "q"), (3, "q"), (4, None), (5, None)], "row int, v string")
    assert [r["duplicate_of"] for r in R.first_position(df, "v", "row").orderBy("row").collect()] == [None, None, 0, 0, None, None]


def test_names_are_resolved_in_order(spark):
    f = spark.createDataFrame([("a.pdf",), ("b  c.pdf",), ("d_2.pdf",), ("e  f_3.pdf",), ("zz.pdf",)], "file string")
    t = spark.createDataFrame([("a.pdf", "A2", 2), ("a.pdf", "A1", 1), ("b c.pdf", "B", 1), ("d.pdf", "D", 1), ("e f.pdf", "E", 1)], "name string, target string, position int")
    assert {r["file"]: r["target"] for r in R.resolve_names(f, t).collect()} == {"a.pdf": "A1", "b  c.pdf": "B", "d_2.pdf": "D", "e  f_3.pdf": "E", "zz.pdf": None}


def test_unique_names(spark):
    df = spark.createDataFrame([(1, "s", "A.pdf"), (2, "s", "a.pdf"), (3, "s", "a.PDF"), (4, "t", "a.pdf")], "i int, g string, name string")
    assert [r["unique_name"] for r in R.unique_names(df, "g", "name", [F.col("i")]).orderBy("i").collect()] == ["A.pdf", "a__2.pdf", "a__3.PDF", "a.pdf"]


def test_longest_run_and_early_stop(spark):
    s = ["ok", "rejected", "blank", "rejected", "rejected", "ok", "rejected"]
    p = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(s)] + [(1, 0, "error"), (2, 1, "ok")], "doc_id int, page int, status string")
    assert {r["doc_id"]: r["longest_run"] for r in O.longest_rejected_run(p).collect()} == {1: 3, 2: 0}
    cut = O.early_stop(p.where("page > 0"), 3).where("doc_id = 1").collect()
    assert sorted((r["page"], r["status"]) for r in cut) == [(0, "doc_skipped")] + [(i + 1, x) for i, x in enumerate(s[:5])]


def test_page_zero_rejects_a_document(spark):
    rows = [(1, "s", 0, 2, "error", None, 0.1, 1), (1, "s", 1, 2, "ok", "word " * 100, 0.1, 1), (1, "s", 2, 2, "error", None, 0.1, 1), (1, "s", 2, 2, "ok", "é " * 300, 0.1, 2), (2, "s", 0, 1, "error", None, 0.0, 1)]
    d = O.compile_documents(spark.createDataFrame(rows, "doc_id int, source string, page int, n_pages int, status string, text string, cost double, n int"), [F.col("n")]).collect()
    assert [(r["doc_id"], r["pages_ok"], r["classification"], r["completeness"]) for r in d] == [(1, 2, "rejected", 1.0)]


def test_urls(spark):
    cells = ["HTTP://Ex.com:443/a?utm_source=x&b=1#f", "ftp://x/y", "http://h", " https://h/?m=1 ", None, ""]
    assert values(spark, U.normalise(c), *cells) == ["http://ex.com/a?b=1", None, "http://h/", "https://h/", None, None]
    assert values(spark, U.drive_link(c), "https://drive.google.com/file/d/ab-1/view", "https://drive.google.com/drive/folders/xy", "https://drive.google.com/", "http://x.org/")[:2] == [("file", "ab-1"), ("folder", "xy")]
    assert values(spark, U.kind(c, "a.org"), "http://a.org/x.PNG", "http://b.org/x.pdf?y", "http://w.a.org/", "http://ba.org/") == ["skip", "document", "page", "outside"]
    assert values(spark, U.direct_download(c), "https://d.com/x?dl=0") == ["https://d.com/x?dl=1"]
    name = values(spark, U.file_name(c), "http://h/a%20b.pdf", "http://h/")
    assert re.fullmatch(r"a_b_[0-9a-f]{8}\.pdf", name[0]) and re.fullmatch(r"file_[0-9a-f]{8}\.bin", name[1])


def test_pages_are_scanned(spark):
    html = '<title> T </title><a class="x" href="/y#z">1</a><a href="http://o.org">2</a><iframe src="mailto:q"></iframe><a href="/y">3</a>'
    got = W.scan(spark.createDataFrame([(1, "http://h.org/x", html), (2, None, None)], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert got[0]["title"] == "T" and got[0]["links"] == ["http://h.org/y", "http://o.org/"]


def test_statistics_of_nothing(spark):
    e = spark.createDataFrame([], "v int, k int, flags string, t long")
    assert S.percentiles(e, "v").first()["n"] == 0 and S.histogram(e, "v").count() == 0
    assert S.flag_counts(e).count() == 0 and S.counts(e, ["k"]).count() == 0 and S.rates(e, "t", "k").count() == 0


def test_seeded_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
    for f in (lambda d: P.per_cell(d, ["g"], "k", 3), lambda d: P.bernoulli(d, "k", 0.2), lambda d: P.share_of_stratum(d, ["g"], "k", 0.1), lambda d: P.round_robin(d, ["g"], "k", 20)):
        a, b = ({tuple(r) for r in f(d).collect()} for d in (df, df.repartition(5)))
        assert a == b and a


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc', None), (2, "", "x")], "i int, s string, t string")
    files.write_csv(df.na.fill(""), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "file", "s")
    assert sorted(r["name"] or "" for r in back.collect()) == ["", 'a "q", b\nc']
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "x.jsonl").write_text('{"i": 1}\n\nnot json\n{"i": 2}\n')
    assert files.read_json_lines(spark, str(tmp_path / "log"), "i int").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_json_lines(spark, str(tmp_path / "log"), "i int", strict=True).collect()
    files.write_shards(spark.range(10), str(tmp_path / "shards"), 3)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 10
    (tmp_path / "m.json").write_text('{"links": {"u": {"status": "done"}, "v": {"status": "dead"}}}')
    assert {tuple(r) for r in files.read_json_map(spark, str(tmp_path / "m.json"), "struct<status:string>", "links").collect()} == {("u", "done"), ("v", "dead")}


def test_stream_counts_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double").write.json(src)
    schema = spark.read.json(src).schema
    run = lambda: progress.write_batches(progress.tail(spark, src, schema), out, ck, lambda b: progress.numbered(b, ["k"]))
    assert progress.run_until_empty(run, lambda: 0) == 1
    first = spark.read.parquet(out).count()
    spark.createDataFrame([("c", 3.0)], "k string, v double").write.mode("append").json(src)
    run().awaitTermination()
    assert first == 2 and spark.read.parquet(out).count() == 3
    assert [r["k"] for r in progress.delta_since(spark, out, 0, 2).collect()] == ["c"]
    assert progress.latest(spark.read.parquet(out), 1).first()["k"] == "c"


def test_token_estimate_is_half_even(spark):
    assert values(spark, T.token_estimate(c), "", "x" * 4, "x" * 12, "x" * 100) == [max(1, round(n / 1.6)) for n in (0, 4, 12, 100)]
    assert math.isclose(values(spark, T.hash01(c, "s"), "k")[0], values(spark, T.hash01(c, "s"), "k")[0])


def test_links_in_messages(spark):
    text = "see https://a.org/x. and (http://m.bad.com/y) https://a.org/x, https://notbad.com/z!"
    assert values(spark, L.candidate_links(c, ("bad.com",)), text, "", None) == [["https://a.org/x", "https://notbad.com/z"], [], None]


def test_robots(spark):
    rules = "User-agent: *\nDisallow: /private\n\nUser-agent: bot\nDisallow: /"
    rows = [(rules, "bot", "http://h/a"), (rules, "bot", "http://h/private/a"), (None, "bot", "http://h/private"), ("", None, None)]
    assert values(spark, L.robots_allow("r", "a", "u"), *rows, ddl="r string, a string, u string") == [True, False, True, True]


def test_sitemaps_are_followed(spark):
    f = [("root", "<sitemapindex><sitemap><loc> s1 </loc></sitemap><sitemap><loc>root</loc></sitemap></sitemapindex>"), ("s1", "<urlset><url><loc>http://h/a?x=1&amp;y=2</loc></url><url><loc>http://h/b</loc></url></urlset>")]
    assert {r["url"] for r in L.sitemap_urls(spark.createDataFrame(f, "url string, xml string"), ["root"]).collect()} == {"http://h/a?x=1&y=2", "http://h/b"}


def test_bounded_names(spark):
    got = values(spark, L.bounded_name(c, 10), "a*b.pdf", "0123456789abc.pdf", None)
    assert got == ["a_b.pdf", "012345.pdf", None]


def test_boundaries(spark):
    df = spark.createDataFrame([(1, "x"), (2, " ")], "i int, t string")
    assert [r[0]["status"] for r in df.select(boundary.stand_in_page(F.col("t"))).collect()] == ["ok", "blank"]
    assert boundary.external(df, lambda b: b.assign(t=b["t"] * 2), "i int, t string").collect()[0]["t"] == "xx"
    assert boundary.token_counter() is T.token_estimate


def test_row_numbers_and_sums_of_a_whole_table(spark):
    df = spark.createDataFrame([((i * 37) % 101, i % 5) for i in range(101)], "k int, v int").repartition(7)
    rows = sorted((r["k"], r["v"]) for r in df.collect())
    got = sequence.row_numbers(df, ["k"]).collect()
    assert sorted((r["k"], r["row_index"]) for r in got) == [(k, i) for i, (k, _) in enumerate(rows)]
    got = {r["k"]: r["before"] for r in sequence.sum_before(df, ["k"], "v").collect()}
    assert all(got[k] == sum(v for _, v in rows[:i]) for i, (k, _) in enumerate(rows))
    assert sequence.row_numbers(df.limit(0), ["k"]).count() == 0
