"""Dear columns stay in one place of the plan: no filter that Catalyst infers or moves evaluates them again."""

import json

from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import chunking as C
from sievework.operators import records as M


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_chunked_once(spark):
    texts = ["", "short", "one line of the text. " * 12, "\n".join("a sentence of words. " * n for n in (9, 40, 3, 12)), None]
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, source string, text string").coalesce(1)
    got = C.chunks(docs)
    assert plan(got).count("(?<=[.!?") == 1  # the split into sentences stands for the fold
    parts = {r["doc_id"]: r["p"] for r in docs.select("doc_id", C.chunk_array(F.coalesce("text", F.lit(""))).alias("p")).collect()}
    want = sorted((i, k, len(p), x) for i, p in parts.items() for k, x in enumerate(p))
    assert len(want) > 3 and sorted((r["doc_key"], r["chunk_index"], r["n_chunks"], r["text"]) for r in got.collect()) == want


def test_responses_are_parsed_once(spark):
    pair = {"question": "q", "answer": "a", "question_type": "factual", "reasoning": " "}
    rows = [(1, json.dumps([pair])), (2, "[]"), (3, "no json"), (4, None), (5, "```json\n" + json.dumps([pair, {}, pair]) + "\n```"), (6, "[1]")]
    g = M.parse_responses(spark.createDataFrame(rows, "k long, response string").coalesce(1), "response")
    assert g.columns == ["k", "status", "pairs"]
    assert {r["k"]: (r["status"], len(r["pairs"])) for r in g.collect()} == {1: ("ok", 1), 2: ("empty", 0), 3: ("parse_error", 0), 4: ("empty", 0), 5: ("ok", 2), 6: ("parse_error", 0)}
    ok = g.where("status = 'ok'").select("k", F.inline("pairs"))
    assert plan(ok).count("parseJson") == 1
    assert sorted((r["k"], r["question"], r["reasoning"]) for r in ok.collect()) == [(1, "q", None), (5, "q", None), (5, "q", None)]


def test_blanks_and_sentences_are_those_of_the_plain_patterns(spark):
    """Every character at both ends, between end marks and in runs of blanks."""
    ends = spark.range(0x110000).where("id < 55296 OR id > 57343").coalesce(1).select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    t = ends.select(F.explode(F.array(F.concat("c", F.lit("x"), "c"), F.concat(F.lit("\n "), "c", F.lit(" \t")), F.concat(F.lit("a. b?"), "c", F.lit(" c!"), "c", "c", F.lit("\n.  "), "c"))).alias("t"))
    t = t.union(spark.createDataFrame([("",), (" ",), (". .\n\n! ? ",), ("..  x.\r\ny",), (None,)], "t string"))
    plain = F.filter(F.split("t", r"(?<=[.!?؟۔।])\s+"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "") != "")
    same = t.agg(F.count("t").alias("texts"), F.count("*").alias("n"), F.count_if(T.strip(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).alias("strip"), F.count_if(T.sentences(F.col("t")).eqNullSafe(plain)).alias("sentences")).first()
    assert same["texts"] + 1 == same["n"] == 3 * (0x110000 - 2048) + 5
    assert same["strip"] == same["n"] and same["sentences"] == same["n"]
