"""Marker words beside letters beyond ASCII: what the flags count is what their SQL counts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import stats as S
from sievework.plans.catalogue import ORACLES, QUERIES
from sievework.profiles import ARABIC_KURDISH
from tests.compare import _value, rows

CONTEXTS = [
    "the éque queé",  # the SQL has der, les and que between letters beyond ASCII: one of the, two of que
    "the que que",
    "the quex _que que1 xque",
    "éthe theé the1 that",
    "the and éder",
    "andß ñder der",
    "the -que- «les»",
    "une the\u0301 que\u0301 les",
    "",
]
N = 10 * len(CONTEXTS)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("edges")
    docs = [(i, CONTEXTS[i % len(CONTEXTS)], "en", "src0", 1) for i in range(N)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{d}/documents.parquet")
    turns = [(i, t, role, f"{role} {i // 2}: {CONTEXTS[(i // 3) % len(CONTEXTS)]}") for i in range(N) for t, role in enumerate(("user", "assistant"))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{d}/conversations.parquet")
    return str(d)


def by_sql(folder, name):
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = c.execute(ORACLES[name])
    at = sorted(range(len(got.description)), key=lambda i: got.description[i][0])
    return sorted(repr([_value(r[i]) for i in at]) for r in got.fetchall())


def test_flag_counts(spark, folder):
    want = by_sql(folder, "flag_counts")
    assert any("lean_context" in r for r in want) and rows(QUERIES["flag_counts"](spark, folder)) == want


@pytest.mark.parametrize(("n", "total"), [(41, 640), (201, 3200), (1, 128)])
def test_shares_are_rounded_as_by_sql(spark, n, total):
    flags = spark.range(total).selectExpr(f"CASE WHEN id < {n} THEN 'a' ELSE '' END AS flags")
    assert S.flag_counts(flags).first()["share"] == duckdb.sql(f"SELECT round({n} / {total}::DOUBLE, 6)").fetchall()[0][0]


def test_outlier_flags(spark, folder):
    got = rows(QUERIES["outlier_flags"](spark, folder))
    assert len(got) == N and got == by_sql(folder, "outlier_flags")


def test_words_of_other_scripts_end_at_letters(spark):
    """The Arabic profile keeps its edges: any letter is part of a word."""
    texts = spark.createDataFrame([("ژ دگەل",), ("ژە ئەڤژ",), ("لە، بە",)], "t string")
    assert [tuple(r["s"]) for r in texts.select(T.leans(F.col("t"), ARABIC_KURDISH).alias("s")).collect()] == [(0, 2, False), (0, 0, False), (2, 0, True)]
