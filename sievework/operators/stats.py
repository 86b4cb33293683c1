"""Profiles of a dataset: counts, percentiles, histograms, prevalence, costs and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.sequence import sum_before

POINTS = {"min": 0.0, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "max": 1.0}


def counts(df: DataFrame, by: list[str], **sums: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c).alias(k) for k, c in sums.items()])


def class_counts(df: DataFrame, by: str, column: str, values: list[str]) -> DataFrame:
    """One column for each of fixed values, in one pass."""
    return df.groupBy(by).agg(F.count("*").alias("n"), *[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def percentiles(df: DataFrame, c: str, by: list[str] | None = None) -> DataFrame:
    """Exact interpolated percentiles, truncated to integers, and the mean to 1 decimal."""
    v = F.col(c)
    points = F.percentile(v, F.array(*map(F.lit, POINTS.values())))
    agg = df.groupBy(*(by or [])).agg(F.count(v).alias("n"), F.bround(F.avg(v), 1).alias("mean"), points.alias("p"))
    return agg.select(*(by or []), "n", "mean", *[F.col("p")[i].cast("long").alias(name) for i, name in enumerate(POINTS)])


def histogram(df: DataFrame, c: str, bins: int = 60) -> DataFrame:
    """(bin, clipped, low, n): counts of all equal bins on [0, max(p99.5, 1)], the last one closed, empty ones too, and a last row of how many values are over p99.5; no rows without values."""
    spark = df.sparkSession
    high, n = df.agg(F.percentile(c, F.lit(0.995)), F.count(c)).first()
    if not n:
        return spark.createDataFrame([], "bin int, clipped boolean, low double, n long")
    top = max(float(high), 1.0)
    v = F.col(c).cast("double")
    b = F.when((v >= 0) & (v <= top), F.least(F.floor(v / F.lit(top / bins)), F.lit(bins - 1)).cast("int"))
    got = df.where(v.isNotNull()).select(F.explode(F.array_compact(F.array(b, F.when(v > F.lit(float(high)), bins)))).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    spine = spark.range(bins + 1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(got, "bin", "left").select("bin", (F.col("bin") == bins).alias("clipped"), F.round(F.col("bin") * F.lit(top) / bins, 6).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))


def codepoints(df: DataFrame, c: str, pattern: str, top: int = 20) -> DataFrame:
    """The most frequent characters of a class, with their share of all of that class."""
    each = df.select(F.explode(F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))
    share = F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6)
    return each.withColumn("share", share).orderBy(F.desc("n"), "ch").limit(top)


def prevalence(df: DataFrame, by: str, affected: dict[str, Column], key: str) -> DataFrame:
    """For each group: rows, rows and distinct keys with each fault, their share in percent, and rows with all of them."""
    both = None
    for test in affected.values():
        both = test if both is None else both & test
    cols = []
    for name, test in affected.items():
        cols += [F.count_if(test).alias(f"n_{name}"), F.count_distinct(F.when(test, F.col(key))).alias(f"keys_{name}"), F.round(100 * F.count_if(test) / F.count("*"), 3).alias(f"pct_{name}")]
    return df.groupBy(by).agg(F.count("*").alias("n"), *cols, F.count_if(both).alias("n_all"))


def concentration(df: DataFrame, by: str, value: str, top: int) -> DataFrame:
    """(n_groups, top_sum, share): what the largest groups have of the total."""
    g = df.groupBy(by).agg(F.sum(value).alias("v"))
    r = g.withColumn("r", F.row_number().over(Window.orderBy(F.desc("v"), by)))
    return r.agg(F.count("*").alias("n_groups"), F.sum(F.when(F.col("r") <= top, F.col("v"))).alias("top_sum"), F.round(F.sum(F.when(F.col("r") <= top, F.col("v"))) / F.sum("v"), 6).alias("share"))


def flag_counts(df: DataFrame, flags: str = "flags") -> DataFrame:
    """(flag, n, share of all rows), most frequent first; a row may have several, joined by semicolons."""
    total = df.count()
    each = df.select(F.explode(F.filter(F.split(flags, ";"), lambda f: f != "")).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    share = F.round(F.col("n") / F.lit(max(total, 1)) * 1e6) / 1e6  # rounded as SQL engines round doubles: 41/640 is 0.064062, not 0.064063
    return each.select("flag", "n", share.alias("share")).orderBy(F.desc("n"), "flag")


def changes(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """(touched, changed, newly): keys in both, with another value, and with a value over 0 where there was none."""
    j = before.select(key, F.col(column).alias("a")).join(after.select(key, F.col(column).alias("b")), key)
    return j.agg(F.count("*").alias("touched"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed"), F.count_if((F.coalesce("a", F.lit(0)) == 0) & (F.coalesce("b", F.lit(0)) > 0)).alias("newly"))


def rates(samples: DataFrame, t: str, n: str, trailing: int = 30) -> DataFrame:
    """Rows each minute between samples (t in seconds), to 1 decimal, without steps of no time, and their trailing mean."""
    w = Window.orderBy(t)
    dt = F.col(t) - F.lag(t).over(w)
    out = samples.withColumn("dt", dt).withColumn("dn", F.col(n) - F.lag(n).over(w)).where("dt > 0")
    out = out.withColumn("rate", F.round(F.col("dn") * 60 / F.col("dt"), 1)).drop("dt", "dn")
    return out.withColumn("trailing", F.round(F.avg("rate").over(w.rowsBetween(1 - trailing, 0)), 6))


def projection(done: Column, total: Column, rate: Column, spent: Column) -> Column:
    """struct(remaining, eta_minutes, projected_cost)."""
    left = F.greatest(total - done, F.lit(0))
    return F.struct(left.alias("remaining"), F.when(rate > 0, F.round(left / rate, 1)).alias("eta_minutes"), F.when(done > 0, F.round(spent / done * total, 6)).alias("projected_cost"))


def within_budget(df: DataFrame, order: list[str], cost: str, budget: float) -> DataFrame:
    """Rows in order until the budget is spent, with the one that crosses it."""
    return sum_before(df, order, cost, "_b").where(F.col("_b") < F.lit(budget)).drop("_b")
