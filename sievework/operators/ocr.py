"""OCR page records to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators.classify import ocr_class
from sievework.operators.relational import keep_latest
from sievework.profiles import LATIN, Gates, ScriptProfile

_NEUTRAL = ("blank", "no_text")


def _runs(pages: DataFrame) -> DataFrame:
    """Rejected pages with their island: anything but rejected and neutral pages ends one; page 0 is no page."""
    w = Window.partitionBy("doc_id").orderBy("page")
    real = pages.where("page > 0").withColumn("_i", F.sum(F.when(F.col("status").isin("rejected", *_NEUTRAL), 0).otherwise(1)).over(w))
    island = Window.partitionBy("doc_id", "_i").orderBy("page")
    return real.withColumn("run", F.sum(F.when(F.col("status") == "rejected", 1).otherwise(0)).over(island)).drop("_i")


def longest_rejected_run(pages: DataFrame) -> DataFrame:
    return _runs(pages).groupBy("doc_id").agg(F.max("run").cast("int").alias("longest_run"))


def early_stop(pages: DataFrame, after: int = 5) -> DataFrame:
    """Pages up to the one at which a run of rejected pages reaches ``after``; where pages follow, a page 0 marks the cut."""
    runs = _runs(pages)
    cut = runs.where(F.col("run") >= after).groupBy("doc_id").agg(F.min("page").alias("cut"))
    last = pages.groupBy("doc_id").agg(F.max("page").alias("last"))
    cut = cut.join(last, "doc_id").where("cut < last").drop("last")
    kept = pages.join(cut, "doc_id", "left").where(F.col("cut").isNull() | (F.col("page") <= F.col("cut"))).select("doc_id", "page", "status")
    return kept.unionByName(cut.select("doc_id", F.lit(0).cast(pages.schema["page"].dataType).alias("page"), F.lit("doc_skipped").alias("status")))


def compile_documents(log: DataFrame, order: list, p: ScriptProfile = LATIN, g: Gates = Gates()) -> DataFrame:
    """One row for each document with a real page: counts by status, text in page order, completeness, ratios and class.

    ``log``: doc_id, source, page, n_pages, status, text, cost; of several records of a page the last counts.
    Any record of page 0 marks the document as skipped.
    """
    pages = keep_latest(log, ["doc_id", "page"], order)
    n = lambda s: F.count_if((F.col("page") > 0) & F.col("status").isin(*s)).alias
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("page") > 0) & (F.col("status") == "ok"), F.struct("page", "text")))), lambda x: x["text"]), "\n\f\n")
    d = pages.groupBy("doc_id").agg(
        F.min("source").alias("source"), F.min_by("n_pages", "page").alias("n_pages"), n(["ok"])("pages_ok"), n(_NEUTRAL)("pages_no_text"), n(["rejected"])("pages_rejected"),
        n(["error", "empty"])("pages_failed"), (F.count_if(F.col("page") == 0) > 0).alias("skipped"), F.count_if(F.col("page") > 0).alias("pages_seen"), joined.alias("text"), F.round(F.sum("cost"), 6).alias("cost"),
    ).where("pages_seen > 0")
    t = F.col("text")
    d = d.withColumns(
        {
            "chars": F.length(t), "script_chars": T.script_letters(t, p), "mark_chars": T.mark_letters(t, p), "script_ratio": T.script_ratio(t, p), "unclear_marks": T.count(t, r"\[\?\]"),
            "completeness": F.bround((F.col("pages_ok") + F.col("pages_no_text")) / F.greatest(F.col("n_pages"), F.lit(1)), 3),
        }
    )
    return d.withColumn("classification", ocr_class(g)).drop("pages_seen")


def completed_prefix(offsets: DataFrame, size: int) -> DataFrame:
    """(file, done): bytes from the start that are there without a gap; offsets are multiples of ``size``."""
    w = Window.partitionBy("file").orderBy("k")
    k = offsets.select("file", (F.col("offset") / size).cast("long").alias("k")).distinct().withColumn("gap", F.col("k") - F.row_number().over(w) + 1)
    return k.groupBy("file").agg((F.count_if(F.col("gap") == 0) * size).alias("done"))
