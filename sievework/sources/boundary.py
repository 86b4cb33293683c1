"""Boundaries: what a deployment plugs in, with deterministic stand-ins that need no network."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sievework.functions import text as T


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_counter(path: str | None = None) -> Callable[[Column], Column]:
    """Token counts by a tokenizer file, loaded once in each worker and used in batches; without a path the estimate."""
    if path is None:
        return T.token_estimate

    @F.pandas_udf(IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        t = _tokenizer(path)
        return pd.Series([len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)], dtype="int32").where(texts.notna())

    return count


def external(df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A client called once for each batch of records; a failed task calls again, so the log is deduplicated by key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield call(b)

    return df.mapInPandas(run, schema)


def stand_in_pairs(text: Column, name: Column) -> Column:
    """JSON of one question and answer about a chunk: an offline generator."""
    pair = F.struct(F.concat(F.lit("What is said in "), name, F.lit("?")).alias("question"), F.substring(text, 1, 80).alias("answer"), F.lit("factual").alias("question_type"), F.lit(" ").alias("reasoning"))
    return F.to_json(F.array(pair))


def stand_in_page(text: Column) -> Column:
    """struct(status, text, input_tokens, output_tokens) of a page read by an offline model: blank pages are not sent."""
    blank = F.coalesce(T.strip(text) == "", F.lit(True))
    return F.struct(
        F.when(blank, "blank").otherwise("ok").alias("status"), F.when(~blank, text).alias("text"), F.when(blank, 0).otherwise(258).alias("input_tokens"), F.when(blank, 0).otherwise(T.token_estimate(text)).alias("output_tokens")
    )
