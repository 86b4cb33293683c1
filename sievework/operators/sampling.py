"""Seeded samples. Every draw is a hash of a key, so it survives repartitioning; salts give independent streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import hash01


def _rank(keys: list[str], key: str, salt: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(hash01(F.col(key), salt), F.col(key)))


def share_of_stratum(df: DataFrame, strata: list[str], key: str, share: float, salt: str = "stratum") -> DataFrame:
    """max(1, int(n * share)) rows of each stratum, without replacement."""
    n = F.count("*").over(Window.partitionBy(*strata))
    take = F.greatest(F.lit(1), F.floor(n * F.lit(share)).cast("int"))
    return df.withColumn("_r", _rank(strata, key, salt)).withColumn("_t", take).where("_r <= _t").drop("_r", "_t")


def per_cell(df: DataFrame, cells: list[str], key: str, k: int, salt: str = "cell") -> DataFrame:
    """k rows of each cell, uniformly: the distributed form of a reservoir for each cell."""
    return df.withColumn("_r", _rank(cells, key, salt)).where(F.col("_r") <= k).drop("_r")


def forced_and_strata(df: DataFrame, strata: list[str], key: str, k: int, forced: Column, salt: str = "audit") -> DataFrame:
    """At most k rows of each stratum, and all rows that are forced; each once."""
    return df.withColumn("_r", _rank(strata, key, salt)).where((F.col("_r") <= k) | F.coalesce(forced, F.lit(False))).drop("_r").dropDuplicates([key])


def bernoulli(df: DataFrame, key: str, rate: float, salt: str = "bernoulli") -> DataFrame:
    return df.where(hash01(F.col(key), salt) < F.lit(rate))


def round_robin(df: DataFrame, cells: list[str], key: str, n: int, per: int = 50, salt: str = "robin") -> DataFrame:
    """n rows taken in turn from the cells, which are ordered by name; at most ``per`` of each. ``pick`` is the order."""
    few = df.withColumn("_r", _rank(cells, key, salt)).where(F.col("_r") <= per)
    return few.orderBy("_r", *cells).limit(n).withColumn("pick", F.row_number().over(Window.orderBy("_r", *cells))).drop("_r")


def every_nth(df: DataFrame, row: str, n: int, most: int | None = None) -> DataFrame:
    out = df.where(F.col(row) % n == 0)
    return out if most is None else out.where(F.col(row) < n * most)


def shuffled(df: DataFrame, key: str, salt: str = "shuffle") -> DataFrame:
    return df.orderBy(hash01(F.col(key), salt), key)


def extrapolate(totals: DataFrame, sampled: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Sample sums scaled by files in all over files sampled, truncated. totals: (by, n_all)."""
    sums = sampled.groupBy(by).agg(F.count("*").alias("n_sampled"), *[F.sum(c).alias(c) for c in columns])
    j = totals.join(sums, by)
    return j.select(by, "n_all", "n_sampled", *[F.floor(F.col(c) * (F.col("n_all") / F.col("n_sampled"))).cast("long").alias(f"est_{c}") for c in columns])
