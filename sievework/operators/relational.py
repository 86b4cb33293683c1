"""Keyed joins, three kinds of dedup, resume logic and name resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DONE = {
    "generation": ("ok", "empty"),
    "ocr": ("ok", "no_text", "blank", "rejected"),
    "download": ("done", "skipped"),
}


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in a total order (ascending columns)."""
    return keep_first(df, keys, [c.desc() for c in order])


def snapshot(log: DataFrame, present: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """A log's latest rows by key, of the keys that are still present."""
    return keep_latest(log, [key], order).join(present.select(key).distinct(), key, "left_semi")


def done(log: DataFrame, kind: str = "generation") -> DataFrame:
    """Rows of a log whose work need not be repeated."""
    return log.where(F.col("status").isin(*DONE[kind]))


def pending(queue: DataFrame, log: DataFrame, keys: list[str], kind: str = "generation") -> DataFrame:
    """What of a queue is not done yet."""
    return queue.join(done(log, kind).select(*keys).distinct(), keys, "left_anti")


def with_context(pairs: DataFrame, chunked: DataFrame, policy: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``pairs`` with the chunk's text as context, and columns of the chunk that are to be carried. Missing chunks: drop, blank, flag (column missing) or fail."""
    c = chunked.select("chunk_id", F.col("text").alias("context"), *carry, F.lit(True).alias("_found"))
    if policy == "drop":
        return pairs.join(c, "chunk_id").drop("_found")
    out = pairs.join(c, "chunk_id", "left")
    if policy == "blank":
        return out.withColumn("context", F.coalesce("context", F.lit(""))).drop("_found")
    if policy == "flag":
        return out.withColumn("missing", F.col("_found").isNull()).drop("_found")
    if policy == "fail":
        checked = F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit("no chunk "), F.coalesce("chunk_id", F.lit("(null)"))))).otherwise(F.col("context"))
        return out.withColumn("context", checked).drop("_found")
    raise ValueError(policy)


def with_defaults(sample: DataFrame, verdicts: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join, each missing field with its default. Catalyst broadcasts the verdicts if their size allows."""
    out = sample.join(verdicts, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def first_position(df: DataFrame, value: str, row: str) -> DataFrame:
    """``df`` with duplicate_of: the first row with the same value, where that is an earlier one."""
    first = F.min(row).over(Window.partitionBy(value))
    return df.withColumn("duplicate_of", F.when(F.col(value).isNotNull() & (F.col(row) > first), first))


def unique_names(df: DataFrame, group: str, name: str, order: list[Column]) -> DataFrame:
    """``df`` with unique_name: of names that differ by case alone, the second gets __2 before its ending, and so on."""
    k = F.row_number().over(Window.partitionBy(group, F.lower(name)).orderBy(*order))
    stem, end = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    return df.withColumn("unique_name", F.when(k == 1, F.col(name)).otherwise(F.concat(stem, F.lit("__"), k.cast("string"), end)))


def resolve_names(files: DataFrame, targets: DataFrame) -> DataFrame:
    """(file, target): the best target for each file (file), by (name, target, position).

    Names are matched as they are, with blanks collapsed, without a _number suffix, and
    without both, in this order; among equals the lowest position wins. Unmatched files have a null target.
    """
    blanks = lambda c: F.regexp_replace(F.trim(c), r"\s+", " ")
    bare = lambda c: F.regexp_replace(c, r"_\d+(?=(?:\.[^.]*)?$)", "")
    f = F.col("file")
    keys = F.array(*[F.struct(F.lit(i).alias("priority"), k.alias("key")) for i, k in enumerate((f, blanks(f), bare(f), bare(blanks(f))))])
    asked = files.select("file", F.explode(keys).alias("k")).select("file", "k.priority", "k.key")
    n = F.col("name")
    by = targets.select(F.explode(F.array_distinct(F.array(n, blanks(n)))).alias("key"), "target", "position")
    hits = asked.join(by, "key", "left")
    best = F.min_by("target", F.when(F.col("target").isNotNull(), F.struct("priority", "position", "target")))
    return hits.groupBy("file").agg(best.alias("target"))


def positions_differ(a: DataFrame, b: DataFrame, row: str, columns: list[str], every: int = 1) -> DataFrame:
    """Every nth row by position in which two tables differ, with rows that one lacks."""
    left = a.where(F.col(row) % every == 0).select(row, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a"))
    right = b.where(F.col(row) % every == 0).select(row, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    differ = F.col("_a").isNull() | F.col("_b").isNull()
    for c in columns:
        differ = differ | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return left.join(right, row, "full").where(differ).drop("_a", "_b")
