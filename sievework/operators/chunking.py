"""Chunks of a token budget: a fold over paragraphs, inside one Catalyst expression.

Paragraphs are packed up to ``target`` tokens; one of more than ``most`` is packed by
sentences up to ``most``, and a sentence beyond that is cut by characters. A chunk of
fewer than ``least`` tokens is appended to the one before it; what is still thin goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.profiles import LATIN, ChunkSizes, ScriptProfile

_STATE = "struct<done:array<string>,open:string,n:int>"


def _pack(items: Column, tokens, limit: int, joiner: str, over: int, oversize) -> Column:
    """Fold: items to array<string> of joined runs of at most ``limit`` tokens; items of more than ``over`` become oversize(item)."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("n")).cast(_STATE)

    def closed(s: Column) -> Column:
        return F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))

    def step(s: Column, x: Column) -> Column:
        n = tokens(x)
        state = lambda done, opened, k: F.struct(done.alias("done"), opened.alias("open"), k.alias("n")).cast(_STATE)
        return (
            F.when(n > over, state(F.concat(closed(s), oversize(x)), F.lit(None).cast("string"), F.lit(0)))
            .when(s["open"].isNotNull() & (s["n"] + n > limit), state(closed(s), x, n))
            .otherwise(state(s["done"], F.when(s["open"].isNull(), x).otherwise(F.concat(s["open"], F.lit(joiner), x)), s["n"] + n))
        )

    return F.aggregate(items, start, step, closed)


def hard_cut(c: Column, k: ChunkSizes) -> Column:
    size = int(k.most * k.chars_per_token)
    return F.transform(F.sequence(F.lit(0), ((F.length(c) - 1) / size).cast("int")), lambda i: c.substr(i * size + 1, F.lit(size)))


def hard_split(c: Column, k: ChunkSizes) -> Column:
    tokens = lambda x: T.token_estimate(x, k.chars_per_token)
    return _pack(T.sentences(c), tokens, k.most, " ", k.most, lambda s: hard_cut(s, k))


def chunk_array(c: Column, k: ChunkSizes = ChunkSizes(), p: ScriptProfile = LATIN) -> Column:
    tokens = lambda x: T.token_estimate(x, k.chars_per_token)
    packed = _pack(T.paragraphs(c, p), tokens, k.target, k.joiner, k.most, lambda x: hard_split(x, k))

    def merge(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & (tokens(x) < k.least), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(last, F.lit(k.joiner), x)))).otherwise(F.concat(done, F.array(x)))

    merged = F.aggregate(packed, F.array().cast("array<string>"), merge)
    return F.filter(merged, lambda x: tokens(x) >= k.least)


def chunks(docs: DataFrame, k: ChunkSizes = ChunkSizes(), p: ScriptProfile = LATIN, origin: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each chunk: chunk_id, document_id, source, origin, chunk_index, n_chunks, char_count, token_estimate, text."""
    doc = T.document_id(F.col("source"), F.col(id_col).cast("string"))
    one = docs.select(F.col(id_col).alias("doc_key"), doc.alias("document_id"), "source", chunk_array(F.coalesce(F.col(text_col), F.lit("")), k, p).alias("parts"))
    # Catalyst filters before a generator over a plain column by that column's size: the fold would run again, twice, in that filter.
    placed = F.transform("parts", lambda x, i: F.struct(i.alias("chunk_index"), x.alias("text")))
    rows = one.select("doc_key", "document_id", "source", F.size("parts").alias("n_chunks"), F.inline(placed))
    return rows.select(
        T.chunk_id(F.lit(origin), F.col("document_id"), F.col("chunk_index")).alias("chunk_id"), "document_id", "source", F.lit(origin).alias("origin"), "chunk_index", "n_chunks",
        F.length("text").alias("char_count"), T.token_estimate(F.col("text"), k.chars_per_token).alias("token_estimate"), "text", "doc_key",
    )


def garbled(chunked: DataFrame, least: float, tokens: Column | None = None) -> DataFrame:
    """document_id of the documents whose chunks' median of characters per token is under ``least``; the median is exact."""
    n = F.col("token_estimate") if tokens is None else tokens
    ratio = F.length("text") / F.greatest(n, F.lit(1))
    return chunked.groupBy("document_id").agg(F.median(ratio).alias("ratio")).where(F.col("ratio") < F.lit(least)).select("document_id", "ratio")


def gate(chunked: DataFrame, least: float, tokens: Column | None = None) -> DataFrame:
    """Chunks of documents that are not garbled."""
    return chunked.join(garbled(chunked, least, tokens).select("document_id"), "document_id", "left_anti")
