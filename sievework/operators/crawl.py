"""Pages and links: extraction, URL dedup, hosts, prefix trees and breadth-first depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import urls as U
from sievework.shared import stored


def scan(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, links): links resolved against the page and normalised, without null and repeated ones."""
    raw = pages.select("page_id", U.normalise(F.col("url")).alias("url"), U.title(F.col("html")).alias("title"), U.resolve(F.col("url"), U.links(F.col("html"))).alias("raw"))
    return raw.select("page_id", "url", "title", F.array_distinct(F.array_compact(F.transform("raw", lambda u: U.normalise(u)))).alias("links"))


def edges(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("url").isNotNull()).select(F.col("url").alias("src"), F.explode("links").alias("dst")).distinct()


def distinct_urls(pages: DataFrame) -> DataFrame:
    """(url, first page, pages) of each normalised URL."""
    return pages.select("page_id", U.normalise(F.col("url")).alias("url")).where(F.col("url").isNotNull()).groupBy("url").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n_pages"))


def host_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy(U.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"), F.count_if(U.is_document(F.col("url"))).alias("n_documents"))


def tree(pages: DataFrame) -> DataFrame:
    """(depth, prefix, n): pages under every prefix of host and path."""
    return pages.select(F.explode(U.prefixes(F.col("url"))).alias("p")).groupBy("p.depth", "p.prefix").agg(F.count("*").alias("n"))


def tree_text(rows: list[tuple[int, str]]) -> str:
    """Indented text of (depth, prefix) rows; for the driver, on a small tree."""
    return "\n".join("  " * d + p.rsplit("/", 1)[-1] for d, p in sorted(rows, key=lambda r: r[1].split("/")))


def depths(links: DataFrame, roots: DataFrame, most: int = 10) -> DataFrame:
    """(url, depth) of all that roots (url) reach within ``most`` steps over ``links`` (src, dst), by frontiers."""
    seen = stored(roots.select("url").distinct().withColumn("depth", F.lit(0)), "bfs")
    frontier = seen
    for d in range(1, most + 1):
        step = frontier.join(links, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        frontier = stored(step.withColumn("depth", F.lit(d)), "bfs")
        if frontier.isEmpty():
            break
        seen = stored(seen.unionByName(frontier), "bfs")
    return seen


def referers(scanned: DataFrame) -> DataFrame:
    """(url, referer): the first page, by id, that links to a page of the table."""
    e = scanned.select("page_id", F.col("url").alias("referer"), F.explode("links").alias("url")).where("url <> referer")
    w = Window.partitionBy("url").orderBy("page_id")
    first = e.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("url", "referer")
    return scanned.select("url").where(F.col("url").isNotNull()).distinct().join(first, "url")


def crawl_summary(fetched: DataFrame) -> DataFrame:
    """(site, pages_total, pages_ok, documents, doc_bytes, errors) of (site, status, is_document, bytes)."""
    return fetched.groupBy("site").agg(
        F.count("*").alias("pages_total"), F.count_if(F.col("status") == 200).alias("pages_ok"), F.count_if(F.col("is_document")).alias("documents"),
        F.coalesce(F.sum(F.when(F.col("is_document"), F.col("bytes"))), F.lit(0)).alias("doc_bytes"), F.count_if(F.col("status") != 200).alias("errors"),
    )
