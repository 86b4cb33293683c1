"""Queries over pages, OCR-like page records and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import urls as U
from sievework.operators import collect as L
from sievework.operators import crawl as W
from sievework.operators import ocr as O
from sievework.operators import stats as S
from sievework.plans.register import query
from sievework.shared import stored, table

_TRACK = ", ".join(f"'{t}'" for t in U.TRACKING)


def _encoded(x: str) -> str:
    """A part of a query decoded as a form's and encoded again."""
    return f"replace(url_encode(url_decode(replace({x}, '+', ' '))), '%20', '+')"


def _norm(c: str) -> str:
    u = f"regexp_replace(trim({c}), '#.*$', '')"
    parts = f"list_filter(string_split(regexp_extract({u}, '\\?([^#]*)', 1), '&'), lambda x: x <> '')"
    kept = f"list_filter(list_transform({parts}, lambda x: {{'k': {_encoded("split_part(x, '=', 1)")}, 'v': {_encoded("substr(x, length(split_part(x, '=', 1)) + 2)")}}}), lambda x: lower(x.k) NOT IN ({_TRACK}))"
    q = f"array_to_string(list_transform({kept}, lambda x: x.k || '=' || x.v), '&')"
    host = f"regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':(?:80|443)$', '')"
    path = f"coalesce(nullif(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/')"
    scheme = f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
    return f"CASE WHEN {scheme} IN ('http', 'https') THEN {scheme} || '://' || {host} || {path} || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END END"


_HOST = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':(?:80|443)$', '')"
_TITLE = r"nullif(substr(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '^\s+|\s+$', '', 'g'), 1, 300), '')"
_LINKS = r"""list_transform(regexp_extract_all(html, '(?i)<(?:a|iframe|embed|object)\b[^>]*?\s(?:href|src|data)\s*=\s*["'']([^"'']*)["'']', 1), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"""


@query("url_normalise", f"SELECT page_id, {_norm('url')} AS url FROM pages")
def url_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", U.normalise(F.col("url")).alias("url"))


@query("url_dedup", f"SELECT url, min(page_id) AS first_page, count(*) AS n_pages FROM (SELECT page_id, {_norm('url')} AS url FROM pages) WHERE url IS NOT NULL GROUP BY url")
def url_dedup(spark: SparkSession, d: str) -> DataFrame:
    return W.distinct_urls(table(spark, d, "pages"))


_DOC = "|".join(U.DOCUMENT_ENDINGS)


@query("host_counts", f"SELECT {_HOST} AS host, count(*) AS n, count(*) FILTER (regexp_matches(lower(url), '\\.(?:{_DOC})(?:[?#]|$)')) AS n_documents FROM pages GROUP BY 1")
def host_counts(spark: SparkSession, d: str) -> DataFrame:
    return W.host_counts(table(spark, d, "pages"))


@query("title_extract", f"SELECT page_id, {_TITLE} AS title FROM pages")
def title_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", U.title(F.col("html")).alias("title"))


@query("page_links", f"SELECT page_id, unnest({_LINKS}) AS link FROM pages")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.explode(U.links(F.col("html"))).alias("link"))


@query(
    "url_tree",
    f"""WITH p AS (SELECT list_concat([{_HOST}], list_filter(string_split(coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/'), '/'), lambda x: x <> '')) AS parts FROM pages)
SELECT (i - 1)::INTEGER AS depth, array_to_string(parts[1:i], '/') AS prefix, count(*) AS n FROM (SELECT parts, unnest(range(1, len(parts) + 1)) AS i FROM p) GROUP BY 1, 2""",
)
def url_tree(spark: SparkSession, d: str) -> DataFrame:
    return W.tree(table(spark, d, "pages"))


@query("bfs_depth")
def bfs_depth(spark: SparkSession, d: str) -> DataFrame:
    """Steps over the links of the pages from where crawls begin: the first page of each host and pages that no other links to."""
    scanned = stored(W.scan(table(spark, d, "pages")).select("page_id", "url", "links"), "scan")
    links = stored(W.edges(scanned), "edges")
    pages = scanned.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("page_id").alias("page_id"))
    first = pages.groupBy(U.host(F.col("url"))).agg(F.min_by("url", "page_id").alias("url")).select("url")
    unlinked = pages.select("url").join(links.where("src <> dst").select(F.col("dst").alias("url")), "url", "left_anti")
    return W.depths(links, first.union(unlinked))


@query("page_scan")
def page_scan(spark: SparkSession, d: str) -> DataFrame:
    """Title and resolved, normalised links of each page."""
    return W.scan(table(spark, d, "pages")).select("page_id", "url", "title", F.size("links").alias("n_links"))


_PAGES_SQL = """
SELECT doc_id, source, (i - 1)::INTEGER AS page, len(parts)::INTEGER AS n_pages, parts[i] AS text,
  CASE WHEN (doc_id + i) % 5 = 0 THEN 'rejected' WHEN length(trim(parts[i])) = 0 THEN 'blank' WHEN (doc_id * 7 + i) % 9 = 0 THEN 'error' ELSE 'ok' END AS status
FROM (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents))
"""


def _page_records(spark: SparkSession, d: str) -> DataFrame:
    """Documents cut into pages at line feeds, with statuses by their numbers: the input of the OCR compile."""
    p = table(spark, d, "documents").select("doc_id", "source", F.split("text", "\n").alias("parts"))
    p = p.select("doc_id", "source", F.size("parts").alias("n_pages"), F.posexplode("parts").alias("page", "text"))
    i = F.col("page") + 1
    status = F.when((F.col("doc_id") + i) % 5 == 0, "rejected").when(F.length(F.trim("text")) == 0, "blank").when((F.col("doc_id") * 7 + i) % 9 == 0, "error").otherwise("ok")
    return p.withColumn("status", status)


@query(
    "ocr_compile",
    f"""WITH p AS (SELECT *, page + 1 AS pg FROM ({_PAGES_SQL})), d AS (
  SELECT doc_id, any_value(source) AS source, any_value(n_pages) AS n_pages, count(*) FILTER (status = 'ok') AS pages_ok, count(*) FILTER (status = 'blank') AS pages_no_text, count(*) FILTER (status = 'rejected') AS pages_rejected,
    count(*) FILTER (status = 'error') AS pages_failed, round(count(*) * 0.001::DOUBLE, 6) AS cost, coalesce(string_agg(text, chr(10) || chr(12) || chr(10) ORDER BY pg) FILTER (status = 'ok'), '') AS text FROM p GROUP BY doc_id
), r AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z]')) AS sc, len(regexp_extract_all(text, '[À-ÿ]')) AS mk, len(regexp_extract_all(text, '\\p{{L}}')) AS al FROM d
)
SELECT doc_id, source, n_pages, pages_ok, pages_no_text, pages_rejected, pages_failed, length(text)::INTEGER AS chars, cost, len(regexp_extract_all(text, '\\[\\?\\]'))::INTEGER AS unclear_marks, round_even((pages_ok + pages_no_text) / greatest(n_pages, 1)::DOUBLE, 3) AS completeness,
  CASE WHEN pages_rejected > pages_ok THEN 'rejected' WHEN length(text) < 200 THEN 'low_text' WHEN CASE WHEN al > 0 THEN round_even(sc / al::DOUBLE, 3) ELSE 0 END < 0.5 THEN 'other_script'
    WHEN mk / greatest(sc, 1)::DOUBLE < 0.02 THEN 'other_language' ELSE 'accepted' END AS classification FROM r""",
)
def ocr_compile(spark: SparkSession, d: str) -> DataFrame:
    log = _page_records(spark, d).withColumn("page", F.col("page") + 1).withColumn("cost", F.lit(0.001))
    out = O.compile_documents(log, [F.col("n_pages")])
    return out.select("doc_id", "source", "n_pages", "pages_ok", "pages_no_text", "pages_rejected", "pages_failed", "chars", "cost", "unclear_marks", "completeness", "classification")


_RUN_SQL = f"""
WITH p AS (SELECT doc_id, page + 1 AS page, status FROM ({_PAGES_SQL})), i AS (
  SELECT *, sum(CASE WHEN status IN ('rejected', 'blank', 'no_text') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page) AS k FROM p
), r AS (SELECT *, sum(CASE WHEN status = 'rejected' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, k ORDER BY page) AS run FROM i)
"""


@query("longest_run", _RUN_SQL + "SELECT doc_id, max(run)::INTEGER AS longest_run FROM r GROUP BY doc_id")
def longest_run(spark: SparkSession, d: str) -> DataFrame:
    return O.longest_rejected_run(_page_records(spark, d).select("doc_id", (F.col("page") + 1).alias("page"), "status"))


@query(
    "early_stop",
    _RUN_SQL
    + """, c AS (SELECT doc_id, min(page) AS cut FROM r WHERE run >= 1 GROUP BY doc_id), l AS (SELECT doc_id, max(page) AS last FROM p GROUP BY doc_id), x AS (SELECT c.doc_id, cut FROM c JOIN l USING (doc_id) WHERE cut < last)
SELECT p.doc_id, p.page::INTEGER AS page, p.status FROM p LEFT JOIN x USING (doc_id) WHERE cut IS NULL OR p.page <= cut UNION ALL SELECT doc_id, 0, 'doc_skipped' FROM x""",
)
def early_stop(spark: SparkSession, d: str) -> DataFrame:
    return O.early_stop(_page_records(spark, d).select("doc_id", (F.col("page") + 1).alias("page"), "status"), 1)


@query("throughput_1m", "SELECT date_trunc('minute', ts) AS minute, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def throughput_1m(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))
    return e.select(F.col("w.start").alias("minute"), "n", "n_users")


_SAMPLES = "SELECT t, sum(n) OVER (ORDER BY t)::BIGINT AS n FROM (SELECT floor(epoch(ts) / 3600)::BIGINT * 3600 AS t, count(*) AS n FROM events GROUP BY 1)"


@query(
    "rates_trailing",
    f"""WITH s AS ({_SAMPLES}), r AS (SELECT t, n, round((n - lag(n) OVER (ORDER BY t)) * 60 / (t - lag(t) OVER (ORDER BY t))::DOUBLE, 1) AS rate, t - lag(t) OVER (ORDER BY t) AS dt FROM s)
SELECT t, n, rate, round(avg(rate) OVER (ORDER BY t ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS trailing FROM r WHERE dt > 0""",
)
def rates_trailing(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    hour = F.expr("floor(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) / 3600) * 3600").cast("long").alias("t")
    n = table(spark, d, "events").groupBy(hour).agg(F.count("*").alias("k"))
    return S.rates(n.select("t", F.sum("k").over(Window.orderBy("t")).alias("n")), "t", "n")


@query("running_counts", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY event_type")
def running_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the stream's counters come to when all events have been read."""
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("completed_prefix", "SELECT file, (count(*) FILTER (g = 0) * 8)::BIGINT AS done FROM (SELECT file, k - row_number() OVER (PARTITION BY file ORDER BY k) + 1 AS g FROM (SELECT DISTINCT o_custkey % 50 AS file, o_orderkey // 50 AS k FROM orders)) GROUP BY file")
def completed_prefix(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("file"), (F.floor(F.col("o_orderkey") / 50) * 8).alias("offset"))
    return O.completed_prefix(o, 8).select("file", F.col("done").cast("long").alias("done"))


@query("streamed_counts", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY event_type")
def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The same counters from a stream of the table, read in one available-now run."""
    from sievework.streaming import progress

    return progress.streamed_counts(spark, f"{d}/events.parquet", table(spark, d, "events").schema, "event_type", "value")


@query(
    "page_link_counters",
    """SELECT lang, count(*) AS links, count(*) FILTER (k = 0) AS downloaded, count(*) FILTER (k IN (2, 3, 5)) AS failed, 0::BIGINT AS pending, count(*) FILTER (k IN (1, 4)) AS skipped
FROM (SELECT regexp_extract(url, '/([a-z]{2})/', 1) AS lang, page_id % 6 AS k FROM pages) GROUP BY lang""",
)
def page_link_counters(spark: SparkSession, d: str) -> DataFrame:
    """Links by outcome; here the outcome follows from the page's number."""
    status = F.element_at(F.array(*map(F.lit, ("done", "skipped", "dead", "failed", "unsupported", "unknown"))), (F.col("page_id") % 6 + 1).cast("int"))
    return L.link_counters(table(spark, d, "pages").select(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"), status.alias("status")), "lang")


@query(
    "provider_compare",
    """WITH p AS (SELECT doc_id, (i - 1)::INTEGER AS page, parts[i] AS text FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
a AS (SELECT doc_id, page, text FROM p WHERE (doc_id + page) % 11 <> 0), b AS (SELECT doc_id, page, CASE WHEN page % 3 = 0 THEN lower(text) ELSE text END AS text FROM p WHERE (doc_id + page) % 13 <> 0)
SELECT doc_id, page, coalesce(length(a.text), -1)::INTEGER AS chars_a, coalesce(length(b.text), -1)::INTEGER AS chars_b,
  CASE WHEN a.text IS NULL THEN 'only b' WHEN b.text IS NULL THEN 'only a' WHEN a.text = b.text THEN 'same' ELSE 'different' END AS verdict FROM a FULL JOIN b USING (doc_id, page)""",
)
def provider_compare(spark: SparkSession, d: str) -> DataFrame:
    """Two readings of each document's pages, side by side."""
    p = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page", "text"))
    a = p.where((F.col("doc_id") + F.col("page")) % 11 != 0)
    b = p.where((F.col("doc_id") + F.col("page")) % 13 != 0).withColumn("text", F.when(F.col("page") % 3 == 0, F.lower("text")).otherwise(F.col("text")))
    out = L.compare_pages(a, b)
    return out.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("chars_a", "chars_b")})


@query("download_summary", "SELECT CASE WHEN page_id % 4 = 0 THEN 'error' ELSE 'done' END AS status, count(*) AS n, sum(CASE WHEN page_id % 4 = 0 THEN 0 ELSE length(html) END)::BIGINT AS bytes FROM pages GROUP BY 1")
def download_summary(spark: SparkSession, d: str) -> DataFrame:
    failed = F.col("page_id") % 4 == 0
    return L.download_summary(table(spark, d, "pages").select(F.when(failed, "error").otherwise("done").alias("status"), F.when(~failed, F.length("html")).alias("bytes")))
