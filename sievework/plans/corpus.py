"""Queries over documents: statistics, classification, chunks, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import chunking as C
from sievework.operators import classify as K
from sievework.operators import relational as R
from sievework.operators import stats as S
from sievework.plans.register import query
from sievework.profiles import ChunkSizes
from sievework.shared import table

_DOCS = "documents"


def _n(pattern: str, c: str = "text") -> str:
    return f"len(regexp_extract_all({c}, '{pattern}'))"


_CC = r"[\x00-\x08\x0b-\x1f\x7f-\x{9f}]"
_PUA = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"
STATS_SQL = rf"""
SELECT doc_id, source, lang, length(text)::INTEGER AS chars, {_n("[À-ÿ]")}::INTEGER AS mark_chars, {_n(_CC)}::INTEGER AS stray_controls,
  CASE WHEN {_n(chr(92) + "p{L}")} > 0 THEN round_even({_n("[A-Za-z]")}::DOUBLE / {_n(chr(92) + "p{L}")}, 3) ELSE 0.0 END AS script_ratio{{more}} FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)
"""
_CO = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"
_PRIVATE = rf"regexp_matches(text, '[\x{{0600}}-\x{{06FF}}]{_CO}[\x{{0600}}-\x{{06FF}}]') AS private_in_words"
CLASS_SQL = f"""
WITH s AS ({STATS_SQL.replace("{more}", ", " + _PRIVATE)})
SELECT *, CASE WHEN chars < 200 THEN 'too short' WHEN script_ratio < 0.5 THEN 'other script' WHEN chars >= 1000 AND mark_chars / chars::DOUBLE < 0.001 THEN 'other language'
  WHEN private_in_words THEN 'private use in words' WHEN stray_controls > 0 THEN 'stray controls' ELSE 'clean' END AS reason FROM s
"""


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return K.text_stats(table(spark, d, _DOCS))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    c = K.extraction_class(F.lit("extracted"))
    return _stats(spark, d).withColumn("c", c).select("doc_id", "source", "lang", "chars", "script_ratio", "mark_chars", "stray_controls", F.col("c.class").alias("class"), F.col("c.reason").alias("reason"))


@query("text_stats", STATS_SQL.replace("{more}", ""))
def text_stats(spark: SparkSession, d: str) -> DataFrame:
    """Characters, script ratio, marks and stray controls of each document."""
    return _stats(spark, d).select("doc_id", "source", "lang", "chars", "mark_chars", "stray_controls", "script_ratio")


@query("classify_docs", f"SELECT doc_id, CASE reason WHEN 'clean' THEN 'safe' ELSE 'ocr_needed' END AS class, reason FROM ({CLASS_SQL})")
def classify_docs(spark: SparkSession, d: str) -> DataFrame:
    """The extraction cascade's class and reason."""
    return _classified(spark, d).select("doc_id", "class", "reason")


@query(
    "class_summary",
    f"SELECT source, count(*) AS n, count(*) FILTER (reason = 'clean') AS n_safe, count(*) FILTER (reason <> 'clean') AS n_ocr_needed, sum(chars)::BIGINT AS chars FROM ({CLASS_SQL}) GROUP BY source",
)
def class_summary(spark: SparkSession, d: str) -> DataFrame:
    """Documents by source and class: the flagship."""
    c = _classified(spark, d)
    return c.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("class") == "safe").alias("n_safe"), F.count_if(F.col("class") == "ocr_needed").alias("n_ocr_needed"), F.sum("chars").alias("chars"))


@query("reason_counts", f"SELECT lang, reason, count(*) AS n FROM ({CLASS_SQL}) GROUP BY lang, reason")
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.counts(_classified(spark, d), ["lang", "reason"])


_AR, _LAT = _n(r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}]"), _n("[A-Za-z]")
SCRIPT_SQL = rf"CASE WHEN {_AR} + {_LAT} < 200 THEN 'image_only_or_empty' WHEN {_AR} > {_LAT} THEN CASE WHEN {_n(r'[\x{06CE}\x{06C6}\x{06A4}\x{0695}\x{06B5}]')} / greatest({_AR}, 1)::DOUBLE > 0.005 THEN 'kurdish' ELSE 'arabic' END ELSE 'latin' END"
_A2, _L2 = _n(r"[\x{0600}-\x{06FF}]", "lower(text)"), _n("[a-z]", "lower(text)")
# DuckDB's word boundary knows ASCII alone: a word begins where no letter, digit, mark or underscore is before it
_AWORDS = r"len(regexp_extract_all(regexp_replace(' ' || lower(text), '([^\p{L}\p{M}\p{N}_])(الله|الى|على|من|في|ال)', '\1' || chr(1), 'g'), chr(1)))"
LANG_SQL = f"CASE WHEN {_A2} > {_L2} AND {_A2} > 20 THEN CASE WHEN {_n("[طظضصذثؤإأكية]", "lower(text)")} + 2 * {_AWORDS} > {_n("[کیڵڕەۆێڤگژچپ]", "lower(text)")} THEN 'arabic' ELSE 'kurdish_arabic' END WHEN {_L2} > {_A2} AND {_L2} > 20 THEN CASE WHEN {_n('[êîûçş]', 'lower(text)')} > 3 THEN 'latin_kurdish' ELSE 'other_latin' END ELSE 'unknown' END"


@query("script_class", f"SELECT doc_id, {SCRIPT_SQL} AS script_class FROM documents")
def script_class(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _DOCS).select("doc_id", K.script_class(F.col("text")).alias("script_class"))


@query("detect_language", f"SELECT doc_id, {LANG_SQL} AS language FROM documents")
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _DOCS).select("doc_id", K.language_class(F.col("text")).alias("language"))


@query(
    "lang_confusion",
    f"SELECT lang, count(*) AS n, count(*) FILTER (c = 'latin_kurdish') AS n_latin_kurdish, count(*) FILTER (c = 'other_latin') AS n_other_latin, count(*) FILTER (c = 'unknown') AS n_unknown FROM (SELECT lang, {LANG_SQL} AS c FROM documents) GROUP BY lang",
)
def lang_confusion(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, _DOCS).select("lang", K.language_class(F.col("text")).alias("c"))
    return S.class_counts(c, "lang", "c", ["latin_kurdish", "other_latin", "unknown"])


@query("token_estimate", "SELECT doc_id, greatest(1, round_even(length(text) / 1.6::DOUBLE, 0))::INTEGER AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _DOCS).select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(
    "sentence_stats",
    r"""SELECT doc_id, len(s)::INTEGER AS n_sentences, coalesce(list_max(list_transform(s, lambda x: length(x))), -1)::INTEGER AS longest
FROM (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?؟۔।])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '') AS s FROM documents)""",
)
def sentence_stats(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, _DOCS).select("doc_id", T.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").alias("n_sentences"), F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(-1)).alias("longest"))


@query("doc_ids", "SELECT doc_id, substr(sha1(source || '/' || doc_id::VARCHAR), 1, 16) AS document_id FROM documents")
def doc_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _DOCS).select("doc_id", T.document_id(F.col("source"), F.col("doc_id").cast("string")).alias("document_id"))


@query(
    "control_prevalence",
    f"""SELECT source, count(*) AS n, count(*) FILTER (a > 0) AS n_control, count(DISTINCT CASE WHEN a > 0 THEN doc_id END) AS keys_control, round(100.0 * count(*) FILTER (a > 0) / count(*), 3) AS pct_control,
  count(*) FILTER (b > 0) AS n_marks, count(DISTINCT CASE WHEN b > 0 THEN doc_id END) AS keys_marks, round(100.0 * count(*) FILTER (b > 0) / count(*), 3) AS pct_marks, count(*) FILTER (a > 0 AND b > 0) AS n_all
FROM (SELECT doc_id, source, {_n(_CC)} + {_n(_PUA)} AS a, {_n("[À-ÿ]")} AS b FROM documents) GROUP BY source""",
)
def control_prevalence(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return S.prevalence(table(spark, d, _DOCS), "source", {"control": T.unprintable(t) > 0, "marks": T.mark_letters(t) > 0}, "doc_id")


@query(
    "codepoint_topk",
    "SELECT ch, count(*) AS n, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM (SELECT unnest(regexp_extract_all(text, '[À-ÿ]')) AS ch FROM documents) GROUP BY ch ORDER BY n DESC, ch LIMIT 20",
)
def codepoint_topk(spark: SparkSession, d: str) -> DataFrame:
    return S.codepoints(table(spark, d, _DOCS), "text", "[À-ÿ]")


@query(
    "source_concentration",
    """WITH g AS (SELECT source, sum(n_chars)::BIGINT AS v FROM documents GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY v DESC, source) AS r FROM g)
SELECT count(*) AS n_groups, sum(v) FILTER (r <= 5)::BIGINT AS top_sum, round(sum(v) FILTER (r <= 5) / sum(v)::DOUBLE, 6) AS share FROM r""",
)
def source_concentration(spark: SparkSession, d: str) -> DataFrame:
    return S.concentration(table(spark, d, _DOCS), "source", "n_chars", 5)


@query("clean_text")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned texts; SQL lacks the compatibility fold, so this is tested against plain Python."""
    return table(spark, d, _DOCS).select("doc_id", T.clean(F.col("text")).alias("text"))


@query("exact_dup_first", "SELECT doc_id, CASE WHEN doc_id > f THEN f ELSE -1 END AS duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS f FROM documents)")
def exact_dup_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, _DOCS).select("doc_id", F.sha2("text", 256).alias("h"))
    return R.first_position(docs, "h", "doc_id").select("doc_id", F.coalesce("duplicate_of", F.lit(-1)).alias("duplicate_of"))


@query("keep_first_text", "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def keep_first_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, _DOCS).select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return R.keep_first(docs, ["h"], [F.col("doc_id")]).select("doc_id", "source")


@query("keep_latest_text", "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS r FROM documents) WHERE r = 1")
def keep_latest_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, _DOCS).select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return R.keep_latest(docs, ["h"], [F.col("doc_id")]).select("doc_id", "source")


def chunked(spark: SparkSession, d: str) -> DataFrame:
    return C.chunks(table(spark, d, _DOCS))


@query("chunks")
def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of every document; the fold is tested against a plain one."""
    return chunked(spark, d).select("chunk_id", "document_id", "source", "origin", "chunk_index", "n_chunks", "char_count", "token_estimate", "text")


@query("chunk_report")
def chunk_report(spark: SparkSession, d: str) -> DataFrame:
    c = chunked(spark, d)
    return c.groupBy("source").agg(F.count("*").alias("n_chunks"), F.count_distinct("document_id").alias("n_documents"), F.sum("token_estimate").alias("tokens"), F.max("token_estimate").alias("longest"))


@query("garble_gate")
def garble_gate(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose chunks have fewer characters per word or mark than 4, by their exact median."""
    return C.garbled(chunked(spark, d), 4.0, T.word_tokens(F.col("text")))


@query(
    "length_percentiles",
    """SELECT lang, count(*) AS n, round_even(avg(n_chars), 1) AS mean, trunc(quantile_cont(n_chars, 0))::BIGINT AS min, trunc(quantile_cont(n_chars, 0.05))::BIGINT AS p05, trunc(quantile_cont(n_chars, 0.25))::BIGINT AS p25,
  trunc(quantile_cont(n_chars, 0.5))::BIGINT AS median, trunc(quantile_cont(n_chars, 0.75))::BIGINT AS p75, trunc(quantile_cont(n_chars, 0.95))::BIGINT AS p95, trunc(quantile_cont(n_chars, 0.99))::BIGINT AS p99, max(n_chars) AS max
FROM documents GROUP BY lang""",
)
def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return S.percentiles(table(spark, d, _DOCS), "n_chars", ["lang"])


@query(
    "length_histogram",
    """WITH t AS (SELECT greatest(quantile_cont(n_chars, 0.995), 1.0) AS top, quantile_cont(n_chars, 0.995) AS high FROM documents), b AS (
  SELECT least(floor(n_chars / (top / 60.0::DOUBLE)), 59)::INTEGER AS bin FROM documents, t WHERE n_chars <= top UNION ALL SELECT 60 FROM documents, t WHERE n_chars > high)
SELECT s.bin::INTEGER AS bin, s.bin = 60 AS clipped, round(s.bin * t.top / 60, 6) AS low, count(b.bin) AS n FROM range(61) s(bin), t LEFT JOIN b ON b.bin = s.bin GROUP BY s.bin, t.top""",
)
def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.histogram(table(spark, d, _DOCS), "n_chars")


@query(
    "size_bands",
    "SELECT source, CASE WHEN n_chars < 10000 THEN 'small' WHEN n_chars < 50000 THEN 'medium' ELSE 'large' END AS band, count(*) AS n FROM documents GROUP BY ALL",
)
def size_bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _DOCS).groupBy("source", K.size_band(F.col("n_chars")).alias("band")).agg(F.count("*").alias("n"))


@query("text_of_chunks")
def text_of_chunks(spark: SparkSession, d: str) -> DataFrame:
    """How much of each document its chunks keep."""
    c = C.chunks(table(spark, d, _DOCS), ChunkSizes()).groupBy("doc_key").agg(F.sum("char_count").alias("kept"))
    return table(spark, d, _DOCS).select("doc_id", "n_chars").join(c, F.col("doc_id") == F.col("doc_key"), "left").select("doc_id", "n_chars", F.coalesce("kept", F.lit(0)).alias("kept"))
