"""Instruction records: parsing model output, building, flattening, restoring and flagging them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.profiles import LATIN, ScriptProfile

QUESTION_TYPES = ("definitional", "explanatory", "factual", "inferential", "summarization")
_PAIRS = "array<struct<question:string,answer:string,question_type:string,reasoning:string>>"
WITH, WITHOUT = "with_context", "no_context"
SYSTEM = {WITH: "Answer from the context.", WITHOUT: "Answer from what you know."}


def _text(v: Column, field: str) -> Column:
    """A field of an object as text, whatever its kind; null where Python's truth is false (missing, null, empty, zero or false)."""
    x = F.try_variant_get(v, f"$.{field}", "variant")
    t = F.try_variant_get(v, f"$.{field}", "string")
    is_text = F.schema_of_variant(x) == "STRING"
    return F.when((F.length(t) > 0) & (is_text | ~t.isin("0", "0.0", "false", "[]", "{}")), t)


def valid_pairs(items: Column) -> Column:
    """Pairs of an array of variants: objects with a question, an answer and a known type (a blank is a question); reasoning is trimmed, or null if empty or no text. Other entries drop out one by one."""
    objects = F.filter(items, lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    kind = lambda v: F.try_variant_get(v, "$.question_type", "string")
    why = lambda v: F.when(F.schema_of_variant(F.try_variant_get(v, "$.reasoning", "variant")) == "STRING", F.nullif(T.strip(F.try_variant_get(v, "$.reasoning", "string")), F.lit("")))
    pairs = F.transform(objects, lambda v: F.struct(_text(v, "question").alias("question"), _text(v, "answer").alias("answer"), kind(v).alias("question_type"), why(v).alias("reasoning")))
    return F.filter(pairs, lambda p: p["question"].isNotNull() & p["answer"].isNotNull() & F.coalesce(p["question_type"].isin(*QUESTION_TYPES), F.lit(False)))


def _items(body: Column) -> Column:
    """The entries of a JSON list as variants; null for anything else."""
    v = F.when(body.startswith("["), F.try_parse_json(body))
    return F.try_variant_get(v, "$", "array<variant>")


def _status(body: Column, items: Column, good: Column) -> Column:
    return (
        F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty")
        .when(items.isNull(), "parse_error")
        .when(F.size(items) == 0, "empty")
        .when(F.size(good) == 0, "parse_error")
        .otherwise("ok")
    )


def parse_response(text: Column) -> Column:
    """struct(status, pairs) of a model's answer: empty, parse_error or ok."""
    body = T.strip_code_fence(text)
    items = _items(body)
    good = valid_pairs(items)
    status = _status(body, items, good)
    return F.struct(status.alias("status"), F.when(status == "ok", good).otherwise(F.array().cast(_PAIRS)).alias("pairs"))


def parse_responses(df: DataFrame, text: str) -> DataFrame:
    """``df`` with status and pairs in place of ``text``; each step is a column of its own, and a filter by status can't be pushed below the generator, so nothing is parsed twice."""
    keep = [c for c in df.columns if c != text]
    steps = df.select(*keep, T.strip_code_fence(F.col(text)).alias("_body")).withColumn("_items", _items(F.col("_body"))).withColumn("_good", valid_pairs(F.col("_items")))
    steps = steps.withColumn("status", _status(F.col("_body"), F.col("_items"), F.col("_good")))
    pairs = F.when(F.col("status") == "ok", F.col("_good")).otherwise(F.array().cast(_PAIRS))
    return steps.select(*keep, F.inline(F.array(F.struct("status", pairs.alias("pairs")))))


def context_mode(key: Column, share: float = 0.7, salt: str = "mode") -> Column:
    return F.when(T.hash01(key, salt) < F.lit(share), WITH).otherwise(WITHOUT)


def user_message(context: Column, question: Column, mode: Column) -> Column:
    return F.when(mode == WITH, F.concat(F.lit("Context: "), context, F.lit("\n\nQuestion: "), question)).otherwise(F.concat(F.lit("Question: "), question))


def build(df: DataFrame) -> DataFrame:
    """(messages, metadata) of (context, question, answer, reasoning, context_mode, document_id, chunk_id, source, question_type)."""
    none = F.lit(None).cast("string")
    role = lambda r, c, why: F.struct(F.lit(r).alias("role"), c.alias("content"), why.alias("reasoning"))
    system = F.when(F.col("context_mode") == WITH, SYSTEM[WITH]).otherwise(SYSTEM[WITHOUT])
    messages = F.array(role("system", system, none), role("user", user_message(F.col("context"), F.col("question"), F.col("context_mode")), none), role("assistant", F.col("answer"), F.nullif(F.col("reasoning"), F.lit(""))))
    meta = F.struct("document_id", "chunk_id", "source", "question_type", "context_mode")
    return df.select(messages.alias("messages"), meta.alias("metadata"))


def flatten(records: DataFrame) -> DataFrame:
    """One column for each role and field; missing reasoning is an empty string."""
    of = lambda r: F.filter("messages", lambda m: m["role"] == r)[0]
    return records.select(of("system")["content"].alias("system"), of("user")["content"].alias("user"), of("assistant")["content"].alias("assistant"), F.coalesce(of("assistant")["reasoning"], F.lit("")).alias("reasoning"), "metadata.*")


def unflatten(rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    role = lambda r, c, why: F.struct(F.lit(r).alias("role"), c.alias("content"), why.alias("reasoning"))
    messages = F.array(role("system", F.col("system"), none), role("user", F.col("user"), none), role("assistant", F.col("assistant"), F.nullif(F.col("reasoning"), F.lit(""))))
    return rows.select(messages.alias("messages"), F.struct("document_id", "chunk_id", "source", "question_type", "context_mode").alias("metadata"))


def split_user(user: Column) -> Column:
    """struct(context, question): at the last question mark-up, else without context, else the whole."""
    sep = "\n\nQuestion: "
    question = F.substring_index(user, sep, -1)
    has = user.startswith("Context: ") & user.contains(sep)
    context = user.substr(F.lit(10), F.length(user) - F.length(question) - 9 - len(sep))
    return F.struct(
        F.when(has, context).alias("context"),
        F.when(has, question).when(user.startswith("Question: "), user.substr(F.lit(11), F.length(user))).otherwise(user).alias("question"),
    )


def restore(records: DataFrame, chunked: DataFrame) -> DataFrame:
    """Records with the context put back where it was left out. A record that breaks the contract fails the job."""
    c = chunked.select(F.col("chunk_id").alias("_id"), F.col("text").alias("_text"))
    j = records.join(c, F.col("metadata.chunk_id") == F.col("_id"), "left")
    one = lambda r: F.size(F.filter("messages", lambda m: m["role"] == r)) == 1
    user = F.filter("messages", lambda m: m["role"] == "user")[0]["content"]
    parts = split_user(user)
    mode = F.col("metadata.context_mode")
    bad = (
        F.when(~(one("system") & one("user") & one("assistant")), "a role is missing or repeated")
        .when(~F.coalesce(mode.isin(WITH, WITHOUT), F.lit(False)), "unknown mode")
        .when((mode == WITHOUT) & F.col("_text").isNull(), "no chunk")
        .when((mode == WITH) & parts["context"].isNull(), "no context")
        .when(F.coalesce(F.length(T.strip(parts["question"])), F.lit(0)) == 0, "no question")
    )
    full = F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit("record of "), F.coalesce(F.col("metadata.chunk_id"), F.lit("(null)")), F.lit(": "), bad))).when(mode == WITH, user).otherwise(user_message(F.col("_text"), parts["question"], F.lit(WITH)))
    messages = F.transform("messages", lambda m: F.when(m["role"] == "user", F.struct(m["role"].alias("role"), full.alias("content"), m["reasoning"].alias("reasoning"))).otherwise(m))
    meta = F.col("metadata").withField("context_mode", F.lit(WITH))
    return j.select(messages.alias("messages"), meta.alias("metadata"))


FLAGS = ("script_in_answer", "lean_context", "lean_answer", "offlist_type", "other_model", "missing_context", "long_prompt", "duplicate_question")


def outlier_flags(rows: DataFrame, p: ScriptProfile = LATIN, foreign: str = "À-ÿ", max_tokens: int = 1300, usual_models: tuple[str, ...] = ("small",)) -> DataFrame:
    """``rows`` (row_index, question, answer, context, context_mode, question_type, model, missing, duplicate_of) with flags, joined by ; in a fixed order."""
    tests = {
        "script_in_answer": T.count(F.col("answer"), f"[{foreign}]") > 0,
        "lean_context": (F.col("context_mode") == WITH) & T.leans(F.col("context"), p)["flag"],
        "lean_answer": T.leans(F.col("answer"), p)["flag"],
        "offlist_type": ~F.coalesce(F.col("question_type").isin(*QUESTION_TYPES), F.lit(False)),
        "other_model": ~F.coalesce(F.col("model").isin(*usual_models), F.lit(False)),
        "missing_context": F.col("missing"),
        "long_prompt": T.token_estimate(user_message(F.col("context"), F.col("question"), F.col("context_mode"))) > max_tokens,
        "duplicate_question": F.col("duplicate_of").isNotNull(),
    }
    flags = F.array(*[F.when(F.coalesce(tests[f], F.lit(False)), F.lit(f)) for f in FLAGS])
    return rows.withColumn("flags", F.array_join(F.array_compact(flags), ";"))
