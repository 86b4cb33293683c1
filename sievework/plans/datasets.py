"""Queries over conversations and documents as instruction records: compile, flag, sample, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import records as M
from sievework.operators import relational as R
from sievework.operators import sampling as P
from sievework.operators import stats as S
from sievework.operators.sequence import row_numbers
from sievework.plans.corpus import chunked
from sievework.plans.register import query
from sievework.shared import stored, table
from sievework.sources.boundary import stand_in_pairs

_H01 = "('0x' || substr(sha1('{salt}|' || {key}::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def _h(key: str, salt: str) -> str:
    return _H01.format(key=key, salt=salt)


_TYPES = ", ".join(f"'{t}'" for t in (*M.QUESTION_TYPES, "opinion"))
PAIRS_SQL = f"""
SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) - 1 AS row_index, u.conv_id, u.turn, u.text AS question, a.text AS answer,
  [{_TYPES}][(u.conv_id + u.turn) % 6 + 1] AS question_type, u.conv_id::VARCHAR || ':' || u.turn::VARCHAR AS pair_id,
  CASE WHEN {_h("u.conv_id::VARCHAR || ':' || u.turn::VARCHAR", "mode")} < 0.7 THEN 'with_context' ELSE 'no_context' END AS context_mode
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant' AND u.text <> '' AND a.text <> ''
"""


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """User turns with the assistant turn that follows: our stand-in for generated pairs."""
    c = table(spark, d, "conversations")
    u = c.where("role = 'user' AND text <> ''").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.where("role = 'assistant' AND text <> ''").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    kinds = F.array(*map(F.lit, (*M.QUESTION_TYPES, "opinion")))
    p = u.join(a, ["conv_id", "turn"])
    p = row_numbers(p, ["conv_id", "turn"])
    p = p.withColumn("question_type", F.element_at(kinds, ((F.col("conv_id") + F.col("turn")) % 6 + 1).cast("int"))).withColumn("pair_id", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    return p.withColumn("context_mode", M.context_mode(F.col("pair_id")))


@query("dialogue_pairs", f"SELECT row_index, conv_id, turn, question, answer, question_type, context_mode FROM ({PAIRS_SQL})")
def dialogue_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).select(F.col("row_index").cast("long").alias("row_index"), "conv_id", "turn", "question", "answer", "question_type", "context_mode")


def _compiled(spark: SparkSession, d: str) -> DataFrame:
    """Pairs joined with the documents they are about, as records are compiled."""
    docs = table(spark, d, "documents").select(F.concat(F.lit("documents-"), F.col("doc_id").cast("string"), F.lit("-000")).alias("chunk_id"), T.document_id(F.col("source"), F.col("doc_id").cast("string")).alias("document_id"), "source", "text")
    p = pairs(spark, d).withColumn("chunk_id", F.concat(F.lit("documents-"), F.col("conv_id").cast("string"), F.lit("-000")))
    joined = R.with_context(p, docs, "drop", ("document_id", "source")).withColumn("reasoning", F.when(F.col("turn") % 2 == 0, F.lit("")))
    return joined


_COMPILED_SQL = f"""
SELECT p.*, d.source, substr(sha1(d.source || '/' || d.doc_id::VARCHAR), 1, 16) AS document_id, 'documents-' || p.conv_id::VARCHAR || '-000' AS chunk_id, d.text AS context
FROM ({PAIRS_SQL}) p JOIN documents d ON d.doc_id = p.conv_id
"""
_USER_SQL = "CASE WHEN context_mode = 'with_context' THEN 'Context: ' || context || chr(10) || chr(10) || 'Question: ' || question ELSE 'Question: ' || question END"


@query(
    "messages_flat",
    f"""SELECT CASE WHEN context_mode = 'with_context' THEN 'Answer from the context.' ELSE 'Answer from what you know.' END AS system, {_USER_SQL} AS user, answer AS assistant, '' AS reasoning,
  document_id, chunk_id, source, question_type, context_mode FROM ({_COMPILED_SQL})""",
)
def messages_flat(spark: SparkSession, d: str) -> DataFrame:
    """Records built, flattened to a table, nested again and flattened again."""
    return M.flatten(M.unflatten(M.flatten(M.build(_compiled(spark, d)))))


@query(
    "context_split",
    f"""WITH u AS (SELECT pair_id, {_USER_SQL} AS u, string_split({_USER_SQL}, chr(10) || chr(10) || 'Question: ') AS p FROM ({_COMPILED_SQL}))
SELECT pair_id, CASE WHEN u LIKE 'Context: %' AND len(p) > 1 THEN substr(array_to_string(p[1:len(p) - 1], chr(10) || chr(10) || 'Question: '), 10) END AS context,
  CASE WHEN u LIKE 'Context: %' AND len(p) > 1 THEN p[len(p)] WHEN u LIKE 'Question: %' THEN substr(u, 11) ELSE u END AS question FROM u""",
)
def context_split(spark: SparkSession, d: str) -> DataFrame:
    c = _compiled(spark, d).select("pair_id", M.split_user(M.user_message(F.col("context"), F.col("question"), F.col("context_mode"))).alias("s"))
    return c.select("pair_id", "s.context", "s.question")


@query("restore_context", f"SELECT chunk_id, 'Context: ' || context || chr(10) || chr(10) || 'Question: ' || question AS user, 'with_context' AS context_mode FROM ({_COMPILED_SQL})")
def restore_context(spark: SparkSession, d: str) -> DataFrame:
    """All records with their context, whether they were compiled with it or not."""
    c = _compiled(spark, d)
    texts = table(spark, d, "documents").select(F.concat(F.lit("documents-"), F.col("doc_id").cast("string"), F.lit("-000")).alias("chunk_id"), "text")
    return M.flatten(M.restore(M.build(c), texts)).select("chunk_id", "user", "context_mode")


@query(
    "pair_counts",
    f"SELECT source, question_type, context_mode, count(*) AS n, count(DISTINCT chunk_id) AS n_chunks FROM ({_COMPILED_SQL}) GROUP BY ALL",
)
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return _compiled(spark, d).groupBy("source", "question_type", "context_mode").agg(F.count("*").alias("n"), F.count_distinct("chunk_id").alias("n_chunks"))


_TOK = "greatest(1, round_even(length({c}) / 1.6::DOUBLE, 0))"


@query(
    "prompt_tokens",
    f"""SELECT context_mode, count(*) AS n, round(avg(t), 6) AS mean_tokens, count(*) FILTER (t > 500) AS n_over, round(100.0 * count(*) FILTER (t > 500) / count(*), 3) AS pct_over, sum(t + 18)::BIGINT AS total_tokens
FROM (SELECT context_mode, {_TOK.format(c="(" + _USER_SQL + ")")}::BIGINT AS t FROM ({_COMPILED_SQL})) GROUP BY context_mode""",
)
def prompt_tokens(spark: SparkSession, d: str) -> DataFrame:
    c = _compiled(spark, d).select("context_mode", T.token_estimate(M.user_message(F.col("context"), F.col("question"), F.col("context_mode"))).alias("t"))
    over = F.count_if(F.col("t") > 500)
    return c.groupBy("context_mode").agg(F.count("*").alias("n"), F.round(F.avg("t"), 6).alias("mean_tokens"), over.alias("n_over"), F.round(100 * over / F.count("*"), 3).alias("pct_over"), F.sum(F.col("t") + 18).alias("total_tokens"))


_MARK = r"len(regexp_extract_all({c}, '\b(?:{w})\b'))"
_FLAGS_SQL = rf"""
WITH p AS ({PAIRS_SQL}), j AS (
  SELECT p.*, d.text AS context, d.doc_id IS NULL AS missing, min(row_index) OVER (PARTITION BY question) AS first_row,
    CASE WHEN row_index % 7 = 3 THEN 'large' ELSE 'small' END AS model FROM p LEFT JOIN documents d ON d.doc_id = p.conv_id
), f AS (
  SELECT *, len(regexp_extract_all(answer, '[À-ÿ]')) > 0 AS f1,
    context_mode = 'with_context' AND {_MARK.format(c="context", w="the|and|that")} > 1.5 * {_MARK.format(c="context", w="der|les|que")} AND {_MARK.format(c="context", w="the|and|that")} > 0 AS f2,
    {_MARK.format(c="answer", w="the|and|that")} > 1.5 * {_MARK.format(c="answer", w="der|les|que")} AND {_MARK.format(c="answer", w="the|and|that")} > 0 AS f3,
    question_type NOT IN ({", ".join(f"'{t}'" for t in M.QUESTION_TYPES)}) AS f4, model <> 'small' AS f5, missing AS f6,
    {_TOK.format(c="(" + _USER_SQL + ")")} > 700 AS f7, row_index > first_row AS f8 FROM j
)
SELECT row_index, array_to_string(list_filter([{", ".join(f"CASE WHEN f{i + 1} THEN '{n}' END" for i, n in enumerate(M.FLAGS))}], lambda x: x IS NOT NULL), ';') AS flags,
  CASE WHEN row_index > first_row THEN first_row ELSE -1 END AS duplicate_of FROM f
"""


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "text")
    p = pairs(spark, d).withColumn("chunk_id", F.col("conv_id").cast("string"))
    rows = R.first_position(R.with_context(p, docs, "flag"), "question", "row_index").withColumn("model", F.when(F.col("row_index") % 7 == 3, "large").otherwise("small"))
    return M.outlier_flags(rows, max_tokens=700)


@query("outlier_flags", _FLAGS_SQL)
def outlier_flags(spark: SparkSession, d: str) -> DataFrame:
    """Eight flags of each pair, joined in a fixed order."""
    return _flagged(spark, d).select(F.col("row_index").cast("long").alias("row_index"), "flags", F.coalesce("duplicate_of", F.lit(-1)).cast("long").alias("duplicate_of"))


@query("flag_counts", f"WITH o AS ({_FLAGS_SQL}) SELECT flag, count(*) AS n, round(count(*) / (SELECT count(*) FROM o)::DOUBLE, 6) AS share FROM (SELECT unnest(string_split(flags, ';')) AS flag FROM o WHERE flags <> '') GROUP BY flag")
def flag_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.flag_counts(_flagged(spark, d))


@query(
    "question_frequency",
    f"SELECT copies, count(*) AS n_questions FROM (SELECT question, count(*) AS copies FROM ({PAIRS_SQL}) GROUP BY question) GROUP BY copies",
)
def question_frequency(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).groupBy("question").agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("n_questions"))


@query("flags_vs_labels", "SELECT quality, toxic, count(*) AS n, count(*) FILTER (length(text) < 200) AS n_short FROM documents JOIN labels USING (doc_id) GROUP BY quality, toxic")
def flags_vs_labels(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.count_if(F.length("text") < 200).alias("n_short"))


@query("context_left_blank", f"SELECT pair_id, coalesce(d.text, '') AS context FROM ({PAIRS_SQL}) p LEFT JOIN documents d ON d.doc_id = p.conv_id")
def context_left_blank(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "text")
    return R.with_context(pairs(spark, d).withColumn("chunk_id", F.col("conv_id").cast("string")), docs, "blank").select("pair_id", "context")


_STATUS = "CASE WHEN doc_id % 3 = 0 THEN 'ok' WHEN doc_id % 3 = 1 THEN 'error' ELSE 'empty' END"


@query("pending_antijoin", f"SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND {_STATUS} IN ('ok', 'empty'))")
def pending_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose labelling, taken as a log, is not done."""
    status = F.when(F.col("doc_id") % 3 == 0, "ok").when(F.col("doc_id") % 3 == 1, "error").otherwise("empty")
    return R.pending(table(spark, d, "documents"), table(spark, d, "labels").withColumn("status", status), ["doc_id"]).select("doc_id", "source")


@query("semi_present", "SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY quality DESC, toxic DESC) AS r FROM labels) WHERE r = 1 AND doc_id IN (SELECT doc_id FROM documents)")
def semi_present(spark: SparkSession, d: str) -> DataFrame:
    return R.snapshot(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id", [F.col("quality"), F.col("toxic")]).select("doc_id", "quality")


@query("label_defaults", "SELECT d.doc_id, coalesce(quality, -1)::INTEGER AS quality, coalesce(toxic, 0)::INTEGER AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def label_defaults(spark: SparkSession, d: str) -> DataFrame:
    return R.with_defaults(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"], {"quality": -1, "toxic": 0})


@query("pools_union", "SELECT 'documents' AS origin, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages")
def pools_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"))
    return a.unionByName(table(spark, d, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"))).groupBy("origin").agg(F.count("*").alias("n"))


def _ranked(salt: str, by: str, key: str = "doc_id", t: str = "documents") -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {_h(key, salt)}, {key}) AS r, count(*) OVER (PARTITION BY {by}) AS n FROM {t}"


@query("stratified_sample", f"SELECT doc_id, source FROM ({_ranked('stratum', 'source')}) WHERE r <= greatest(1, floor(n * 0.05::DOUBLE))")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return P.share_of_stratum(table(spark, d, "documents"), ["source"], "doc_id", 0.05).select("doc_id", "source")


@query("forced_plus_strata", f"SELECT doc_id FROM ({_ranked('audit', 'source, lang')}) WHERE r <= 2 OR n_chars < 100")
def forced_plus_strata(spark: SparkSession, d: str) -> DataFrame:
    return P.forced_and_strata(table(spark, d, "documents"), ["source", "lang"], "doc_id", 2, F.col("n_chars") < 100).select("doc_id")


@query("reservoir_cells", f"SELECT doc_id, source, lang FROM ({_ranked('cell', 'source, lang')}) WHERE r <= 5")
def reservoir_cells(spark: SparkSession, d: str) -> DataFrame:
    return P.per_cell(table(spark, d, "documents"), ["source", "lang"], "doc_id", 5).select("doc_id", "source", "lang")


@query("bernoulli_sample", f"SELECT doc_id FROM documents WHERE {_h('doc_id', 'bernoulli')} < 0.1")
def bernoulli_sample(spark: SparkSession, d: str) -> DataFrame:
    return P.bernoulli(table(spark, d, "documents"), "doc_id", 0.1).select("doc_id")


@query("round_robin_sample", f"SELECT doc_id, row_number() OVER (ORDER BY r, source, lang)::INTEGER AS pick FROM ({_ranked('robin', 'source, lang')}) WHERE r <= 50 QUALIFY pick <= 120")
def round_robin_sample(spark: SparkSession, d: str) -> DataFrame:
    return P.round_robin(table(spark, d, "documents"), ["source", "lang"], "doc_id", 120).select("doc_id", "pick")


@query("every_nth_row", "SELECT doc_id FROM documents WHERE doc_id % 97 = 0 AND doc_id < 97 * 400")
def every_nth_row(spark: SparkSession, d: str) -> DataFrame:
    return P.every_nth(table(spark, d, "documents"), "doc_id", 97, 400).select("doc_id")


@query(
    "extrapolated_chars",
    f"""WITH s AS (SELECT source, count(*) AS n_sampled, sum(n_chars)::BIGINT AS c FROM ({_ranked('site', 'source')}) WHERE r <= 10 GROUP BY source), t AS (SELECT source, count(*) AS n_all FROM documents GROUP BY source)
SELECT source, n_all, n_sampled, floor(c * (n_all / n_sampled::DOUBLE))::BIGINT AS est_n_chars FROM s JOIN t USING (source)""",
)
def extrapolated_chars(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return P.extrapolate(docs.groupBy("source").agg(F.count("*").alias("n_all")), P.per_cell(docs, ["source"], "doc_id", 10, "site"), "source", ["n_chars"])


_RATES = {"small": (0.25, 1.5), "large": (1.25, 5.0)}


@query(
    "cost_by_model",
    """WITH c AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'large' WHEN 2 THEN 'other' END AS model, greatest(1, round_even(n_chars / 1.6::DOUBLE, 0))::INTEGER AS i, (n_chars % 500)::INTEGER AS o FROM documents)
SELECT coalesce(model, '(default)') AS model, count(*) AS calls, sum(i)::BIGINT AS tokens_in, sum(o)::BIGINT AS tokens_out,
  round(sum(round_even((i * CASE WHEN coalesce(model, 'small') = 'small' THEN 0.25 ELSE 1.25 END::DOUBLE + o * CASE WHEN coalesce(model, 'small') = 'small' THEN 1.5 ELSE 5.0 END::DOUBLE) / 1e6, 8)), 8) AS cost FROM c GROUP BY model""",
)
def cost_by_model(spark: SparkSession, d: str) -> DataFrame:
    model = F.when(F.col("doc_id") % 4 == 0, "small").when(F.col("doc_id") % 4 == 1, "large").when(F.col("doc_id") % 4 == 2, "other")
    c = table(spark, d, "documents").select(model.alias("model"), T.token_estimate(F.col("text")).alias("i"), (F.col("n_chars") % 500).cast("int").alias("o"))
    c = c.withColumn("cost", T.cost(F.col("i"), F.col("o"), F.col("model"), _RATES, "small", 8))
    return c.groupBy(F.coalesce("model", F.lit("(default)")).alias("model")).agg(F.count("*").alias("calls"), F.sum("i").alias("tokens_in"), F.sum("o").alias("tokens_out"), F.round(F.sum("cost"), 8).alias("cost"))


@query("budget_stop", "SELECT doc_id, n_chars FROM (SELECT *, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) WHERE b < 100000")
def budget_stop(spark: SparkSession, d: str) -> DataFrame:
    """Documents in order until their characters exceed a budget."""
    return S.within_budget(table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], "n_chars", 100_000)


@query(
    "name_resolve",
    """WITH t AS (SELECT 'doc_' || (doc_id // 2)::VARCHAR || '.txt' AS name, doc_id AS target FROM documents), b AS (SELECT name, min(target) AS target FROM t GROUP BY name)
SELECT 'doc_' || doc_id::VARCHAR || '.txt' AS file, coalesce(b.target, b0.target, -1) AS target
FROM documents LEFT JOIN b ON b.name = 'doc_' || doc_id::VARCHAR || '.txt' LEFT JOIN b b0 ON b0.name = 'doc.txt'""",
)
def name_resolve(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    files = docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"))
    targets = docs.select(F.concat(F.lit("doc_"), F.floor(F.col("doc_id") / 2).cast("string"), F.lit(".txt")).alias("name"), F.col("doc_id").alias("target"), F.col("doc_id").alias("position"))
    return R.resolve_names(files, targets).select("file", F.coalesce("target", F.lit(-1)).alias("target"))


@query(
    "unique_file_names",
    "SELECT doc_id, CASE WHEN k = 1 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '__' || k::VARCHAR || '.txt' END AS unique_name FROM (SELECT doc_id, name, row_number() OVER (PARTITION BY source, lower(name) ORDER BY doc_id) AS k FROM (SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN 'Doc' ELSE 'doc' END || (doc_id // 40)::VARCHAR || '.txt' AS name FROM documents))",
)
def unique_file_names(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.when(F.col("doc_id") % 2 == 0, "Doc").otherwise("doc"), F.floor(F.col("doc_id") / 40).cast("string"), F.lit(".txt"))
    return R.unique_names(table(spark, d, "documents").select("doc_id", "source", name.alias("name")), "source", "name", [F.col("doc_id")]).select("doc_id", "unique_name")


@query("generated_records")
def generated_records(spark: SparkSession, d: str) -> DataFrame:
    """Chunks through an offline generator, its JSON parsed, first answers kept, joined with their chunks and counted."""
    c = stored(chunked(spark, d).select("chunk_id", "document_id", "source", "text"), "chunks")  # read three times below
    made = stand_in_pairs(F.col("text"), F.col("chunk_id"))
    response = F.when(F.length("text") % 11 == 0, "[]").when(F.length("text") % 13 == 0, "no json").otherwise(F.concat(F.lit("```json\n"), made, F.lit("\n```")))
    g = M.parse_responses(c.select("chunk_id", "document_id", "source", response.alias("response")), "response")
    first = R.keep_first(g.where("status = 'ok'"), ["chunk_id"], [F.col("document_id")])
    p = first.select("chunk_id", "document_id", "source", F.inline("pairs"))
    p = p.withColumn("context_mode", M.context_mode(F.col("chunk_id")))
    flat = M.flatten(M.build(R.with_context(p, c, "drop")))
    return flat.groupBy("source", "context_mode").agg(F.count("*").alias("n"), F.sum(F.length("user")).alias("user_chars"), F.count_if(F.col("reasoning") != "").alias("n_reasoning"))
