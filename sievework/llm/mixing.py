"""Mixing sources to target weights: hierarchical budgeting.

Leaves of the tree are (domain, lang, source). A token budget goes down the tree: a
node's budget is shared by its children in proportion to their weights, and what a
child can't use (it holds ``max_epochs`` times its tokens at most) is shared again by
its siblings; a node asks no more than its children hold, so only what all siblings
together lack goes to the ancestors' other children.

A leaf's quota is filled from seeded epochs: epoch e is the order of its documents by
md5(seed:e:doc_id). Whole epochs come first, then of the next one the longest
prefix whose tokens fit.

The prefix is found without sorting a leaf: tokens are summed by the leading hex
digits of the hash, the one bucket where the quota ends is sorted, and what comes
back is one cutoff for each leaf, so documents are not shuffled.

Defined results: a null or empty text has no tokens and is never selected; null
levels are leaves of their own with weight ``default_weight``; weights of zero get
nothing unless all siblings have zero; rows that tie in hash (repeated rows, null
doc_ids) are taken or left together; an empty table selects nothing. Columns are
addressed under names of this module's own, so others may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.shared import stored, table

LEVELS = ("domain", "lang", "source")
_HEX = 3


@dataclass(frozen=True)
class MixParams:
    """``budget``: tokens to select, or None for ``share`` of all tokens; ``weights``: level -> name -> weight."""

    budget: int | None = None
    share: float = 1.0
    max_epochs: int = 3
    seed: int = 17
    default_weight: float = 1.0
    weights: dict = field(
        default_factory=lambda: {
            "domain": {"web": 4.0, "reference": 3.0, "forum": 2.0, "archive": 1.0},
            "lang": {"en": 6.0, "de": 1.5, "fr": 1.5, "es": 1.0},
            "source": {},
        }
    )


#: Domain of a source by its number; a source without one is web.
DOMAINS = ("web", "reference", "forum", "archive")


def domain_of(source: Column) -> Column:
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), number % len(DOMAINS) + 1)


def token_count(text: Column) -> Column:
    """Runs of characters other than ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x09-\x0d\x20]+")), F.lit(0)).cast("long")


def _weight(name: Column, weights: dict[str, float], default: float) -> Column:
    if not weights:
        return F.lit(default)
    found = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.coalesce(name, F.lit(""))]
    return F.coalesce(found, F.lit(default))


def water_fill(nodes: DataFrame, parent: list[str], name: str, budget: str) -> DataFrame:
    """``nodes`` (parent..., name, capacity, weight, budget of the parent) with ``quota``: min(capacity, level * weight).

    Children are ordered by capacity / weight; the first that is not full sets the level, which later ones would only lower.
    """
    key = [F.col(c) for c in parent]
    every = Window.partitionBy(*key)
    n = nodes.withColumn("w", F.when(F.sum("weight").over(every) > 0, F.col("weight")).otherwise(F.lit(1.0)))
    n = n.withColumn("ratio", F.when(F.col("w") > 0, F.col("capacity") / F.col("w")).otherwise(F.lit(float("inf"))))
    order = every.orderBy("ratio", F.col(name).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    n = n.withColumn("left_over", F.col(budget) - F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("w_rest", F.sum("w").over(rest))
    level = F.when(F.col("w_rest") > 0, F.col("left_over") / F.col("w_rest"))
    n = n.withColumn("level", F.max(F.when(F.col("ratio") > level, level)).over(every))
    quota = F.when(F.col("level").isNull(), F.when(F.col("w") > 0, F.col("capacity")).otherwise(0)).otherwise(F.least(F.col("capacity").cast("double"), F.greatest(F.col("level"), F.lit(0.0)) * F.col("w")))
    return n.withColumn("quota", F.floor(quota).cast("long")).drop("w", "ratio", "left_over", "w_rest", "level")


def quotas(leaves: DataFrame, p: MixParams) -> DataFrame:
    """(domain, lang, source, tokens, quota) from (domain, lang, source, tokens)."""
    capacity = leaves.withColumn("capacity", F.col("tokens") * p.max_epochs)
    total = Window.partitionBy(F.lit(1))
    budget = F.lit(p.budget).cast("long") if p.budget is not None else F.floor(F.sum("tokens").over(total) * F.lit(p.share)).cast("long")
    n = capacity.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    n = n.withColumn("budget", budget).withColumn("weight", _weight(F.col("domain"), p.weights.get("domain", {}), p.default_weight)).withColumn("top", F.lit(1))
    above = water_fill(n, ["top"], "domain", "budget").select(F.col("domain").alias("d"), F.col("quota").alias("budget"))
    n = capacity.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    n = n.join(above, F.col("domain").eqNullSafe(F.col("d"))).withColumn("weight", _weight(F.col("lang"), p.weights.get("lang", {}), p.default_weight))
    above = water_fill(n, ["domain"], "lang", "budget").select(F.col("domain").alias("d"), F.col("lang").alias("l"), F.col("quota").alias("budget"))
    n = capacity.join(above, F.col("domain").eqNullSafe(F.col("d")) & F.col("lang").eqNullSafe(F.col("l"))).withColumn("weight", _weight(F.col("source"), p.weights.get("source", {}), p.default_weight))
    return water_fill(n, ["domain", "lang"], "source", "budget").select(*LEVELS, "tokens", "quota")


def _hash(epoch: Column, seed: int, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def plan(slim: DataFrame, p: MixParams) -> DataFrame:
    """For each leaf (m_domain, m_lang, m_source): whole epochs, and the greatest hash taken from the next (null: none). ``slim``: domain, lang, source, doc_id, tokens."""
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaf = stored(quotas(leaves, p).where("tokens > 0").withColumn("full", F.floor(F.col("quota") / F.col("tokens")).cast("int")).withColumn("rest", F.col("quota") % F.col("tokens")), "mix-leaves")
    mine = leaf.select(*[F.col(c).alias(f"m_{c}") for c in LEVELS], "full", "rest")
    same = [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in LEVELS]
    rows = slim.where("tokens > 0").join(mine.where("rest > 0"), same).withColumn("h", _hash(F.col("full"), p.seed, F.col("doc_id"))).withColumn("bucket", F.left("h", F.lit(_HEX)))
    by = [f"m_{c}" for c in LEVELS]
    sums = rows.groupBy(*by, "bucket").agg(F.sum("tokens").alias("n"), F.any_value("rest").alias("rest"), F.max("h").alias("last"))
    run = Window.partitionBy(*by).orderBy("bucket")
    sums = stored(sums.withColumn("upto", F.sum("n").over(run)), "mix-buckets")
    whole = sums.where("upto <= rest").groupBy(*by).agg(F.max("last").alias("cut"))
    border = sums.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).groupBy(*by).agg(F.min_by("bucket", "bucket").alias("b"), F.min_by(F.col("upto") - F.col("n"), "bucket").alias("base"))
    b = border.select(*[F.col(c).alias(f"b_{c}") for c in by], "b", "base")
    inside = rows.join(b, [F.col("bucket") == F.col("b"), *[F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in by]])
    ties = inside.groupBy(*by, "h").agg(F.sum("tokens").alias("n"), F.any_value("base").alias("base"), F.any_value("rest").alias("rest"))
    part = ties.withColumn("upto", F.col("base") + F.sum("n").over(Window.partitionBy(*by).orderBy("h"))).where("upto <= rest").groupBy(*by).agg(F.max("h").alias("cut"))
    cuts = whole.unionByName(part).groupBy(*by).agg(F.max("cut").alias("m_cut"))
    c = cuts.select(*[F.col(x).alias(f"c_{x}") for x in by], "m_cut")
    out = mine.join(c, [F.col(x).eqNullSafe(F.col(f"c_{x}")) for x in by], "left")
    return stored(out.select(*by, F.col("full").alias("m_full"), "m_cut"), "mix-plan")


def mix(docs: DataFrame, p: MixParams = MixParams()) -> tuple[DataFrame, str]:
    """(``docs`` with one row for each epoch that selects it, name of the added epoch column)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    slim = docs.select(domain_of(F.col("source")).alias("domain"), "lang", "source", "doc_id", token_count(F.col("text")).alias("tokens"))
    leaf = plan(stored(slim, "mix-slim"), p)
    epoch = "m_epoch"
    while epoch in docs.columns:
        epoch += "_"
    d = docs.select(F.struct(*own).alias("row"))
    at = [domain_of(F.col("row.source")).eqNullSafe(F.col("m_domain")), F.col("row.lang").eqNullSafe(F.col("m_lang")), F.col("row.source").eqNullSafe(F.col("m_source"))]
    picked = d.where(token_count(F.col("row.text")) > 0).join(leaf, at)
    last = F.when(_hash(F.col("m_full"), p.seed, F.col("row.doc_id")) <= F.col("m_cut"), F.array("m_full")).otherwise(F.array().cast("array<int>"))
    epochs = F.concat(F.when(F.col("m_full") > 0, F.sequence(F.lit(0), F.col("m_full") - 1)).otherwise(F.array().cast("array<int>")), last)
    return picked.select("row", F.explode(epochs).alias(epoch)).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], epoch), epoch


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every selected document and epoch: 60 % of all tokens, by weight."""
    out, epoch = mix(table(spark, sf_dir, "documents"), MixParams(share=0.6))
    return out.select("doc_id", F.col(epoch).alias("epoch"), domain_of(F.col("source")).alias("domain"), "lang", "source", token_count(F.col("text")).alias("n_tokens"))
