"""Rows that the given tables lack, through the queries and their SQL side by side."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from sievework.functions import urls as U
from sievework.operators import records as M
from sievework.operators import reports as B
from sievework.operators import stats as S
from sievework.plans.catalogue import ORACLES, QUERIES
from sievework.sources import files
from tests.compare import TABLES, _value, rows

PUA = chr(0xE123)
TEXTS = [
    "الله على من في الى " * 20,
    "کوردی ڕۆژ ێوارە ڵەم گەڕان چاک پێ ژین " * 12,
    "abc " * 80 + f"سلا{PUA}م " + "é",
    "abc " * 80 + f"x{PUA}y é",
    "abc " * 80 + "é\x07",
    "",
    "ê î û ş ç abc " * 30,
    "الرجل " * 40 + "word " * 3,
    "a\n\n\nb",
    "x" * 500,
    None,
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("inline")
    docs = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    pages = ["http://a.org/x?q=a b&z", "HTTP://a.org:80/?UTM_source=1&b=%C3%A9+c&b=*~", "http://a.org/?q=50%&r=%zz", "http://a.org/p?=v&&k=", "https://b.org", "mailto:x", None]
    spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return str(d)


def _sql(folder, sql):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = c.execute(sql)
    names = [x[0] for x in got.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_value(r[i]) for i in at]) for r in got.fetchall())


@pytest.mark.parametrize("name", ["text_stats", "classify_docs", "class_summary", "script_class", "detect_language", "length_histogram", "url_normalise", "url_dedup"])
def test_queries_agree_on_awkward_rows(spark, folder, name):
    if name in ("script_class", "detect_language"):  # of a null text the SQL can say nothing
        assert [r for r in rows(QUERIES[name](spark, folder)) if r[:4] != "[10,"] == [r for r in _sql(folder, ORACLES[name]) if r[:4] != "[10,"]
    else:
        assert rows(QUERIES[name](spark, folder)) == _sql(folder, ORACLES[name])


def test_all_classes_occur(spark, folder):
    got = {r["language"] for r in QUERIES["detect_language"](spark, folder).collect()}
    assert {"arabic", "kurdish_arabic", "latin_kurdish", "other_latin", "unknown"} <= got
    assert "private use in words" in {r["reason"] for r in QUERIES["classify_docs"](spark, folder).collect()}


def test_queries_are_encoded_as_forms_are(spark):
    df = spark.createDataFrame([("http://a.org/x?q=a b&a",), ("http://a.org/?b=%C3%A9+c*~&m=2",), ("http://a.org/?q=50%",)], "u string")
    assert [r[0] for r in df.select(U.normalise(F.col("u"))).collect()] == ["http://a.org/x?q=a+b&a=", "http://a.org/?b=%C3%A9+c%2A~", "http://a.org/?q=50%25"]


def test_bad_entries_drop_out_one_by_one(spark):
    good = {"question": "q", "answer": "a", "question_type": "factual", "reasoning": "r"}
    cells = [[1, good], ["s", good, None, [good]], [{**good, "reasoning": 7}], [{**good, "answer": 42}], [{**good, "question": 0}], [{**good, "question": []}], [1], [{**good, "question_type": 3}]]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(cells)], "i int, t string")
    want = [("ok", 1), ("ok", 1), ("ok", 1), ("ok", 1), ("parse_error", 0), ("parse_error", 0), ("parse_error", 0), ("parse_error", 0)]
    for got in (df.select("i", M.parse_response(F.col("t")).alias("r")).select("i", "r.*"), M.parse_responses(df, "t")):
        r = got.orderBy("i").collect()
        assert [(x["status"], len(x["pairs"])) for x in r] == want
        assert r[0]["pairs"][0]["reasoning"] == "r" and r[2]["pairs"][0]["reasoning"] is None and r[3]["pairs"][0]["answer"] == "42"


def test_histograms_have_all_bins_and_flags_an_order(spark):
    h = S.histogram(spark.createDataFrame([(1.0,), (5.0,), (100.0,), (None,)], "v double"), "v").orderBy("bin").collect()
    assert len(h) == 61 and sum(r["n"] for r in h[:60]) == 2 and h[60]["n"] == 1 and h[60]["clipped"]
    f = S.flag_counts(spark.createDataFrame([("a;b",), ("b",), ("c;b",), ("",), (None,)], "flags string")).collect()
    assert [(r["flag"], r["n"]) for r in f] == [("b", 3), ("a", 1), ("c", 1)] and f[0]["share"] == 0.6


def test_reports(spark, tmp_path):
    t = spark.createDataFrame([("a {n} {x}", "S")], "text string, source string")
    assert t.select(B.filled("{source}: {text} {n}{n}", text=F.col("text"), source=F.col("source"), n=F.lit("2"))).first()[0] == "S: a {n} {x} 22"
    with pytest.raises(ValueError):
        files.markdown(spark.range(5), most=4)
    (tmp_path / "web_v.json").write_text(json.dumps([{"id": 1, "ok": True}, {"id": 2, "ok": False}]))
    assert {(r["id"], r["ok"], r["origin"]) for r in files.read_verdicts(spark, str(tmp_path)).collect()} == {(1, True, "web"), (2, False, "web")}
    found = spark.createDataFrame([("b", "p2", "folder"), ("b", "p1", "table"), ("a", "p3", "x")], "source string, path string, kind string")
    known = spark.createDataFrame([("a", "own", "k")], "source string, path string, kind string")
    assert {tuple(r) for r in B.registry(known, found).collect()} == {("a", "own", "k"), ("b", "p1", "table")}


def test_the_tables_are_known():
    assert "documents" in TABLES
