"""Queries of queues, registries, reviews and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import classify as K
from sievework.operators import ocr as O
from sievework.operators import reports as B
from sievework.plans import datasets, web
from sievework.plans.register import ORACLES, query
from sievework.shared import table

_FILES_SQL = """
SELECT doc_id, source, 'doc_' || doc_id::VARCHAR || '.txt' AS file, len(string_split(text, chr(10)))::INTEGER AS pages, strlen(text)::INTEGER AS bytes,
  round_even(length(text) / len(string_split(text, chr(10)))::DOUBLE, 1) AS per_page, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) = '')) / len(string_split(text, chr(10)))::DOUBLE AS empties FROM documents
"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as extracted files: a line is a page."""
    t = F.col("text")
    parts = F.split(t, "\n")
    f = table(spark, d, "documents").select("doc_id", "source", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), F.size(parts).alias("pages"), F.octet_length(t).alias("bytes"), F.bround(F.length(t) / F.size(parts), 1).alias("per_page"), (F.size(F.filter(parts, lambda x: F.trim(x) == "")) / F.size(parts)).alias("empties"))
    return f.withColumn("status", K.extraction_status(F.col("per_page"), F.lit(0.0), F.col("empties"), F.lit(None).cast("string")))


@query(
    "extraction_status",
    f"SELECT doc_id, CASE WHEN per_page < 40 THEN 'needs_ocr' WHEN empties > 0.5 THEN 'extracted_partial' ELSE 'extracted' END AS status FROM ({_FILES_SQL})",
)
def extraction_status(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("doc_id", "status")


@query("needs_ocr_queue", f"SELECT source, file, pages, bytes FROM ({_FILES_SQL}) WHERE per_page < 40")
def needs_ocr_queue(spark: SparkSession, d: str) -> DataFrame:
    return B.ocr_queue(_files(spark, d))


@query(
    "source_registry",
    """SELECT * FROM (VALUES ('src0', 'static/src0', 'folder'), ('mail', 'static/mail', 'table')) v(source, path, kind)
UNION ALL SELECT source, 'found/' || source, 'folder' FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) WHERE source NOT IN ('src0', 'mail')""",
)
def source_registry(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([("src0", "static/src0", "folder"), ("mail", "static/mail", "table")], "source string, path string, kind string")
    found = table(spark, d, "documents").where("source IS NOT NULL").select("source", F.concat(F.lit("found/"), "source").alias("path"), F.lit("folder").alias("kind"))
    return B.registry(known, found)


@query("wanted_documents", "SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src1', 'src2') AND lang IN ('en', 'de') AND doc_id::VARCHAR LIKE '%1%'")
def wanted_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("lang").alias("origin"), F.col("doc_id").cast("string").alias("document"))
    return B.wanted(docs, ("src0", "src1", "src2"), ("en", "de"), "1").select("doc_id", "source")


def _compiled(spark: SparkSession, d: str) -> DataFrame:
    return web.ocr_compile(spark, d)


@query("review_queue", f"SELECT doc_id, source, classification, unclear_marks FROM ({ORACLES['ocr_compile']}) ORDER BY classification = 'accepted', unclear_marks DESC, source, doc_id LIMIT 40")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return B.review_queue(_compiled(spark, d)).select("doc_id", "source", "classification", "unclear_marks")


@query(
    "ocr_by_source",
    f"SELECT source, count(*) AS docs, sum(pages_ok)::BIGINT AS pages_ok, sum(chars)::BIGINT AS chars, count(*) FILTER (classification = 'accepted') AS n_accepted, count(*) FILTER (classification <> 'accepted') AS n_other FROM ({ORACLES['ocr_compile']}) GROUP BY source",
)
def ocr_by_source(spark: SparkSession, d: str) -> DataFrame:
    return B.by_source(_compiled(spark, d))


@query(
    "pair_dimensions",
    f"""WITH c AS (SELECT source, question_type, context_mode, turn % 2 = 1 AS r FROM ({datasets._COMPILED_SQL}))
SELECT 'source' AS dimension, source AS value, count(*) AS n, count(*) FILTER (r) AS n_reasoning FROM c GROUP BY source UNION ALL SELECT 'question_type', question_type, count(*), count(*) FILTER (r) FROM c GROUP BY question_type
UNION ALL SELECT 'context_mode', context_mode, count(*), count(*) FILTER (r) FROM c GROUP BY context_mode UNION ALL SELECT 'all', NULL, count(*), count(*) FILTER (r) FROM c""",
)
def pair_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, and those with reasoning, by source, question type, context mode and in all."""
    c = datasets._compiled(spark, d).withColumn("reasoning", F.when(F.col("turn") % 2 == 1, F.lit("why")))
    return B.dimension_counts(c, ["source", "question_type", "context_mode"], n_reasoning=F.count_if(F.coalesce(F.length("reasoning"), F.lit(0)) > 0))


@query(
    "catalogue_union",
    """WITH a AS (SELECT unnest(['doc_' || doc_id::VARCHAR || '.txt', source || '/' || doc_id::VARCHAR]) AS name, doc_id AS target, 0 AS position FROM documents),
b AS (SELECT unnest(['page_' || page_id::VARCHAR || '.html', url]) AS name, page_id AS target, 1 AS position FROM pages) SELECT DISTINCT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE name IS NOT NULL""",
)
def catalogue_union(spark: SparkSession, d: str) -> DataFrame:
    i, j = F.col("doc_id").cast("string"), F.col("page_id").cast("string")
    a = table(spark, d, "documents").select(F.array(F.concat(F.lit("doc_"), i, F.lit(".txt")), F.concat("source", F.lit("/"), i)).alias("names"), F.col("doc_id").alias("target"))
    b = table(spark, d, "pages").select(F.array(F.concat(F.lit("page_"), j, F.lit(".html")), F.col("url")).alias("names"), F.col("page_id").alias("target"))
    return B.catalogue(a, b)


@query(
    "counts_by_either_key",
    """WITH a AS (SELECT doc_id % 50 AS k, count(*) AS n_documents FROM documents GROUP BY 1), b AS (SELECT page_id % 70 AS k, count(*) AS n_pages FROM pages GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(n_documents, 0) AS n_documents, coalesce(n_pages, 0) AS n_pages FROM a FULL JOIN b ON a.k = b.k""",
)
def counts_by_either_key(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").groupBy((F.col("doc_id") % 50).alias("k")).agg(F.count("*").alias("n_documents"))
    return B.zero_filled(a, table(spark, d, "pages").groupBy((F.col("page_id") % 70).alias("k")).agg(F.count("*").alias("n_pages")), "k")


@query("labelled_and_discussed", "SELECT doc_id FROM labels INTERSECT SELECT conv_id FROM conversations")
def labelled_and_discussed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("doc_id").intersect(table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")))


_TEMPLATE = "Text from {source}:\n{text}\nAsk {n} questions."


@query("filled_prompts", "SELECT doc_id, 'Text from ' || coalesce(source, '') || ':' || chr(10) || coalesce(text, '') || chr(10) || 'Ask 4 questions.' AS prompt FROM documents")
def filled_prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", B.filled(_TEMPLATE, text=F.col("text"), source=F.col("source"), n=F.lit("4")).alias("prompt"))


@query("chunk_origins", f"SELECT split_part(chunk_id, '-', 1) AS origin, count(*) AS n FROM ({datasets._COMPILED_SQL}) GROUP BY 1")
def chunk_origins(spark: SparkSession, d: str) -> DataFrame:
    return datasets._compiled(spark, d).groupBy(B.origin_of(F.col("chunk_id")).alias("origin")).agg(F.count("*").alias("n"))


@query(
    "word_estimates",
    "SELECT source, sum(w)::BIGINT AS words, floor(sum(w) * 1.3::DOUBLE)::BIGINT AS tokens_low, floor(sum(w) * 1.6::DOUBLE)::BIGINT AS tokens_middle, floor(sum(w) * 2.0::DOUBLE)::BIGINT AS tokens_high FROM (SELECT source, len(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY source",
)
def word_estimates(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").groupBy("source").agg(F.sum(B.word_count(F.col("text"), "A-Za-zÀ-ÿ")).alias("words"))
    return w.select("source", "words", *B.token_range(F.col("words")))
