"""Collection records: links in messages, robots rules, sitemaps, downloads, two providers' pages."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sievework.functions import urls as U

#: Outcome of a link to the counter that it adds to.
OUTCOMES = {"done": "downloaded", "skipped": "skipped", "unsupported": "skipped", "dead": "failed", "failed": "failed", "pending": "pending"}


def candidate_links(text: Column, excluded: tuple[str, ...] = ()) -> Column:
    """Distinct http(s) links of a text in their order, without punctuation at the end and without hosts under excluded domains."""
    found = F.regexp_extract_all(text, F.lit(r"(https?://[^\s<>\"']+)"), 1)
    bare = F.transform(found, lambda x: F.regexp_replace(x, r"[).,;:!?\]}»]+$", ""))

    def wanted(x: Column) -> Column:
        out = U.host(x) != ""
        for d in excluded:
            out = out & ~U.in_scope(x, d)
        return out

    return F.array_distinct(F.filter(bare, wanted))


@F.pandas_udf(BooleanType())
def robots_allow(rules: pd.Series, agent: pd.Series, url: pd.Series) -> pd.Series:
    """Whether the agent or any agent may fetch a URL by the text of its robots file; without one it may."""
    parsed: dict = {}

    def one(text, who, target):
        if not text or target is None:
            return True
        if text not in parsed:
            parsed[text] = RobotFileParser()
            parsed[text].parse(text.splitlines())
        return parsed[text].can_fetch(who or "*", target) or parsed[text].can_fetch("*", target)

    return pd.Series([one(*x) for x in zip(rules, agent, url)], dtype="boolean")


def sitemap_locations(xml: Column) -> Column:
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), 1), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))


def sitemap_urls(files: DataFrame, roots: list[str], most: int = 5) -> DataFrame:
    """(url) of all pages that sitemaps name; ``files``: (url, xml). An index is followed to ``most`` levels."""
    level = files.where(F.col("url").isin(*roots))
    out = None
    for _ in range(most + 1):
        named = level.select(F.col("xml").rlike(r"(?i)<sitemapindex\b").alias("index"), F.explode(sitemap_locations(F.col("xml"))).alias("url"))
        pages = named.where("NOT index").select("url")
        out = pages if out is None else out.union(pages)
        level = files.join(named.where("index").select("url").distinct(), "url", "left_semi")
    return out.distinct()


def link_counters(links: DataFrame, by: str = "channel") -> DataFrame:
    """One row for each channel: links by the counter of their outcome, and in all."""
    kind = F.lit("failed")
    for status, counter in OUTCOMES.items():
        kind = F.when(F.col("status") == status, counter).otherwise(kind)
    return links.withColumn("_k", kind).groupBy(by).agg(F.count("*").alias("links"), *[F.count_if(F.col("_k") == k).alias(k) for k in sorted(set(OUTCOMES.values()))])


def download_summary(manifest: DataFrame) -> DataFrame:
    """(status, n, bytes) of a manifest (status, bytes)."""
    return manifest.groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def compare_pages(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pages of two providers side by side (doc_id, page, chars_a, chars_b, verdict), with those that one lacks."""
    x = a.select("doc_id", "page", F.length("text").alias("chars_a"), F.sha2("text", 256).alias("ha"))
    y = b.select("doc_id", "page", F.length("text").alias("chars_b"), F.sha2("text", 256).alias("hb"))
    verdict = F.when(F.col("ha").isNull() & F.col("hb").isNull(), "neither").when(F.col("ha").isNull(), "only b").when(F.col("hb").isNull(), "only a").when(F.col("ha") == F.col("hb"), "same").otherwise("different")
    return x.join(y, ["doc_id", "page"], "full").select("doc_id", "page", "chars_a", "chars_b", verdict.alias("verdict"))


def bounded_name(name: Column, most: int = 180) -> Column:
    """A file name with other than word characters as _ and at most ``most`` characters, its ending kept."""
    clean = F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w.\- ]+", "_"), r"\s+", " ")
    end = F.regexp_extract(clean, r"(\.[A-Za-z0-9]{1,8})$", 1)
    stem = F.substring(clean, F.lit(1), F.length(clean) - F.length(end))
    return F.when(F.length(clean) <= most, clean).otherwise(F.concat(F.substring(stem, F.lit(1), F.lit(most) - F.length(end)), end))
