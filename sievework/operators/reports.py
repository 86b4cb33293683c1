"""Queues, registries, reviews and reports over classified documents and generated pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MULTIPLIERS = {"low": 1.3, "middle": 1.6, "high": 2.0}


def ocr_queue(docs: DataFrame) -> DataFrame:
    """(source, file, pages, bytes) of the documents whose status is needs_ocr, and of no others that OCR might help, in order of source and file."""
    return docs.where("status = 'needs_ocr'").select("source", "file", "pages", "bytes").orderBy("source", "file")


def registry(known: DataFrame, found: DataFrame) -> DataFrame:
    """(source, path, kind): the known sources, and those found that aren't known. A source that is found on several paths has the least."""
    new = found.groupBy("source").agg(F.min_by(F.struct("path", "kind"), "path").alias("f")).select("source", "f.path", "f.kind").join(known.select("source"), "source", "left_anti")
    return known.select("source", "path", "kind").unionByName(new)


def wanted(df: DataFrame, sources: tuple[str, ...] = (), origins: tuple[str, ...] = (), contains: str | None = None) -> DataFrame:
    """Rows of any of the sources, of any of the origins, with a part of their document's name; an empty filter lets all pass. All three reach the scan."""
    if sources:
        df = df.where(F.col("source").isin(*sources))
    if origins:
        df = df.where(F.col("origin").isin(*origins))
    return df.where(F.col("document").contains(contains)) if contains else df


def review_queue(compiled: DataFrame, most: int = 40) -> DataFrame:
    """The first ``most`` documents to review: not accepted before accepted, more unclear marks first, then by source and id."""
    order = [F.col("classification") == "accepted", F.desc("unclear_marks"), "source", "doc_id"]
    return compiled.orderBy(*order).limit(most)


def by_source(compiled: DataFrame) -> DataFrame:
    """Documents, pages read, characters, accepted and other documents of each source of an OCR compile."""
    accepted = F.count_if(F.col("classification") == "accepted")
    return compiled.groupBy("source").agg(F.count("*").alias("docs"), F.sum("pages_ok").alias("pages_ok"), F.sum("chars").alias("chars"), accepted.alias("n_accepted"), (F.count("*") - accepted).alias("n_other"))


def dimension_counts(pairs: DataFrame, dimensions: list[str], **sums: Column) -> DataFrame:
    """(dimension, value, n, sums...) for each value of each dimension, and for all rows (dimension "all"), in one pass by grouping sets."""
    cols = [F.col(d) for d in dimensions]
    grouped = pairs.groupingSets([[c] for c in cols] + [[]], *cols).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"), *[v.alias(k) for k, v in sums.items()])
    which, value = F.lit("all"), F.lit(None).cast("string")
    for i, d in enumerate(dimensions):
        mine = F.col("_g") == (1 << len(dimensions)) - 1 - (1 << (len(dimensions) - 1 - i))
        which, value = F.when(mine, d).otherwise(which), F.when(mine, F.col(d).cast("string")).otherwise(value)
    return grouped.select(which.alias("dimension"), value.alias("value"), "n", *sums)


def catalogue(*parts: DataFrame) -> DataFrame:
    """(name, target, position): the names of several catalogues of (names array, target), those of earlier catalogues first."""
    out = None
    for i, p in enumerate(parts):
        rows = p.select(F.explode("names").alias("name"), "target", F.lit(i).alias("position"))
        out = rows if out is None else out.unionByName(rows)
    return out.where(F.col("name").isNotNull()).distinct()


def zero_filled(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """All keys of two tables of counts; a count that one lacks is 0."""
    j = a.join(b, key, "full")
    return j.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in j.columns if c != key])


def filled(template: str, **fields: Column) -> Column:
    """A template with each {name} replaced once; what stands in the values is never a field itself."""
    out: list[Column] = []
    rest = template
    while rest:
        at = min((i for k in fields if (i := rest.find("{" + k + "}")) >= 0), default=-1)
        if at < 0:
            out.append(F.lit(rest))
            break
        name = rest[at + 1 : rest.index("}", at)]
        out += [F.lit(rest[:at]), F.coalesce(fields[name], F.lit(""))]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*out) if out else F.lit("")


def origin_of(chunk_id: Column) -> Column:
    """What stands before the first hyphen."""
    return F.substring_index(chunk_id, "-", 1)


def word_count(text: Column, letters: str = r"\\x{0600}-\\x{077F}") -> Column:
    """Runs of letters of a script."""
    return F.regexp_count(text, F.lit(f"[{letters}]+"))


def token_range(words: Column, multipliers: dict[str, float] = MULTIPLIERS) -> list[Column]:
    """Estimated tokens for so many words, by each multiplier, rounded down."""
    return [F.floor(words * F.lit(m)).cast("long").alias(f"tokens_{k}") for k, m in multipliers.items()]
