"""URL filters: gradient-boosted trees on lexical features.

Features are Catalyst expressions of the URL alone: lengths, depth, digit ratios,
entropies, counts of parameters, hyphens and subdomains, and statistics of the
host's suffix (its share of all URLs, and its smoothed share of bad ones among the
labelled). Trees are grown on the logistic loss by histogram splits with Newton leaves;
the fitted model is compiled to CASE expressions, so scoring stays in the JVM.

Training uses about ``max_train_rows`` labelled URLs (a documented parameter): those whose
seeded hash is under the threshold that lets so many of all labelled rows pass. The share of bad
ones of a suffix is taken, for a training row, over the other folds of the sample, so a row's own
label isn't in its features. Suffix shares are counted over all URLs, and all are scored.

Defined results: a null or blank URL has a null score and is not kept; a URL
without scheme is read as host and path; repeated rows get equal scores; a URL
labelled more than once takes its largest label, and labels that are null or not 0/1
are ignored; with labels of one class only, every URL scores that class's prior and
is kept; URLs of any length are read whole; equal hashes are taken or left together; an empty table gives no
rows. Only page_id and url are read, whatever other columns there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.shared import table

#: Families of hosts that are known to be bad; a URL is labelled by whether its host has one of them.
BLOCKED = ("casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x")


@dataclass(frozen=True)
class UrlParams:
    max_train_rows: int = 20_000
    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    l2: float = 1.0
    min_hessian: float = 1.0
    threshold: float = 0.5
    seed: int = 3


@dataclass
class Trees:
    """``nodes`` of a tree: (feature, cut, left, right) or (None, value, 0, 0); a value over the cut goes right."""

    names: list[str]
    base: float = 0.0
    trees: list[list[tuple]] = field(default_factory=list)
    suffix_rate: dict[str, float] = field(default_factory=dict)
    prior: float = 0.0
    threshold: float = 0.5

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            at = np.zeros(len(x), dtype=int)
            for _ in range(16):
                f = np.array([-1 if n[0] is None else n[0] for n in t])[at]
                if (f < 0).all():
                    break
                cut = np.array([n[1] for n in t])[at]
                nxt = np.where(x[np.arange(len(x)), np.maximum(f, 0)] > cut, np.array([n[3] for n in t])[at], np.array([n[2] for n in t])[at])
                at = np.where(f < 0, at, nxt)
            out += np.array([n[1] for n in t])[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, names: list[str], p: UrlParams) -> Trees:
    """Boosted trees on rows ``x`` with labels ``y`` of both classes."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, p.bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T)])
    rate = y.mean()
    model = Trees(names, float(np.log(rate / (1 - rate))))
    z = np.full(len(y), model.base)
    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-z))
        g, h = y - q, q * (1 - q)
        nodes: list[tuple] = []
        add = np.zeros(len(y))

        def grow(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append(())
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, -1)
            if depth < p.depth:
                for f, b in enumerate(binned):
                    gl = np.cumsum(np.bincount(b[rows], weights=g[rows], minlength=len(cuts[f]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b[rows], weights=h[rows], minlength=len(cuts[f]) + 1))[:-1]
                    gain = gl**2 / (hl + p.l2) + (gs - gl) ** 2 / (hs - hl + p.l2) - gs**2 / (hs + p.l2)
                    gain[(hl < p.min_hessian) | (hs - hl < p.min_hessian)] = 0
                    if len(gain) and gain.max() > best[0] + 1e-9:
                        best = (float(gain.max()), f, int(gain.argmax()))
            if best[1] < 0:
                value = float(p.rate * gs / (hs + p.l2))
                add[rows] = value
                nodes[at] = (None, value, 0, 0)
            else:
                over = binned[best[1]][rows] > best[2]
                left, right = grow(rows[~over], depth + 1), grow(rows[over], depth + 1)
                nodes[at] = (best[1], float(cuts[best[1]][best[2]]), left, right)
            return at

        grow(np.arange(len(y)), 0)
        model.trees.append(nodes)
        z += add
    return model


def _entropy(s: Column) -> Column:
    """Bits for each character."""
    n = F.length(s)
    one = lambda acc, c: acc - (F.lit(1.0) * (n - F.length(F.replace(s, c))) / n) * F.log2(F.lit(1.0) * (n - F.length(F.replace(s, c))) / n)
    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(s, "")), F.lit(0.0), lambda acc, c: F.when(F.length(c) > 0, one(acc, c)).otherwise(acc))).otherwise(F.lit(0.0))


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, url, u, host, path, query, suffix) of each page."""
    u = F.lower(F.trim("url"))
    p = pages.select("page_id", "url", F.nullif(u, F.lit("")).alias("u"))
    host = F.regexp_replace(F.regexp_extract("u", r"^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)", 1), r"^[^@]*@|:[0-9]*$", "")
    p = p.withColumn("host", host).withColumn("path", F.regexp_extract("u", r"^(?:[a-z][a-z0-9+.-]*://)?[^/?#]*(/[^?#]*)?", 1)).withColumn("query", F.regexp_extract("u", r"\?([^#]*)", 1))
    return p.withColumn("suffix", F.regexp_extract("host", r"((?:\b(?:co|com|org|net|ac|gov)\.[a-z]{2}|[^.]*))$", 1))


def features(p: DataFrame, shares: DataFrame) -> tuple[DataFrame, list[str]]:
    """``p`` (of parts) with the numbers f_*. ``shares``: (s, f_suffix_share) of all suffixes."""
    count = lambda c, r: F.regexp_count(c, F.lit(r)).cast("double")
    share = lambda c, r: F.when(F.length(c) > 0, F.regexp_count(c, F.lit(r)) / F.length(c)).otherwise(F.lit(0.0))
    made = {
        "f_url_length": F.length("u").cast("double"),
        "f_host_length": F.length("host").cast("double"),
        "f_path_length": F.length("path").cast("double"),
        "f_query_length": F.length("query").cast("double"),
        "f_depth": count(F.col("path"), "/[^/]"),
        "f_params": count(F.col("query"), "[^&]+"),
        "f_subdomains": count(F.col("host"), r"\."),
        "f_host_hyphens": count(F.col("host"), "-"),
        "f_path_hyphens": count(F.col("path"), "[-_]"),
        "f_url_digits": share(F.col("u"), "[0-9]"),
        "f_host_digits": share(F.col("host"), "[0-9]"),
        "f_host_entropy": _entropy(F.col("host")),
        "f_path_entropy": _entropy(F.col("path")),
        "f_longest_label": F.array_max(F.transform(F.split("host", r"\."), F.length)).cast("double"),
        "f_secure": F.col("u").startswith("https:").cast("double"),
    }
    out = p.withColumns(made).join(shares, F.col("suffix") == F.col("s"), "left").drop("s")
    return out, [*made, "f_suffix_share"]


def suffix_shares(p: DataFrame) -> DataFrame:
    """The share of all URLs with each suffix."""
    counts = p.where("u IS NOT NULL").groupBy(F.col("suffix").alias("s")).agg(F.count("*").alias("n"))
    total = p.where("u IS NOT NULL").count()
    return counts.select("s", (F.col("n") / F.lit(max(total, 1))).alias("f_suffix_share"))


def sampled(labels: DataFrame, p: UrlParams) -> Column:
    """Whether a url is under the threshold of the sample."""
    share = min(1.0, p.max_train_rows / max(labels.count(), 1))
    return F.pmod(F.xxhash64(F.lit(p.seed), "url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def suffix_rates(suffixes: list[str], y: np.ndarray, prior: float) -> dict[str, float]:
    """The smoothed share of bad ones of each suffix that occurs often enough."""
    count: dict[str, list[float]] = {}
    for s, label in zip(suffixes, y):
        c = count.setdefault(s, [0.0, 0.0])
        c[0] += label
        c[1] += 1
    return {s: float((a + 20 * prior) / (n + 20)) for s, (a, n) in count.items() if n >= 20}


def train(feats: DataFrame, names: list[str], labels: DataFrame, p: UrlParams, folds: int = 5) -> Trees:
    """Fit on ``labels`` (url, label)."""
    labels = labels.where(F.col("label").isin(0, 1) & F.col("url").isNotNull())
    mine = sampled(labels, p)
    y = labels.where(mine).groupBy("url").agg(F.max("label").alias("label"))
    rows = feats.where(F.col("u").isNotNull() & mine).join(y, "url").groupBy("url").agg(F.max("label").alias("label"), F.any_value("suffix").alias("suffix"), *[F.any_value(n).alias(n) for n in names])
    got = rows.toPandas().sort_values("url", kind="stable")
    y = got["label"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return Trees([*names, "f_suffix_rate"], threshold=1.0)
    prior = float(y.mean())
    suffixes = list(got["suffix"])
    fold = np.arange(len(y)) % folds
    rate = np.full(len(y), prior)
    for k in range(folds):
        others = suffix_rates([s for s, f in zip(suffixes, fold) if f != k], y[fold != k], prior)
        rate[fold == k] = [others.get(s, prior) for s, f in zip(suffixes, fold) if f == k]
    model = fit(np.column_stack([got[names].to_numpy(dtype=float), rate]), y, [*names, "f_suffix_rate"], p)
    model.suffix_rate, model.prior, model.threshold = suffix_rates(suffixes, y, prior), prior, p.threshold
    return model


def score(model: Trees) -> Column:
    """The probability that a URL is bad, as an expression of the features."""
    def expression(t: list[tuple], i: int) -> Column:
        f, value, left, right = t[i]
        if f is None:
            return F.lit(value)
        return F.when(F.col(model.names[f]) > F.lit(value), expression(t, right)).otherwise(expression(t, left))

    z = F.lit(model.base)
    for t in model.trees:
        z = z + expression(t, 0)
    return 1 / (1 + F.exp(-z))


def rated(feats: DataFrame, model: Trees) -> DataFrame:
    """``feats`` with f_suffix_rate, as score() needs it."""
    rate = F.lit(model.prior)
    if model.suffix_rate:
        rate = F.coalesce(F.create_map(*[F.lit(x) for kv in sorted(model.suffix_rate.items()) for x in kv])[F.col("suffix")], rate)
    return feats.withColumn("f_suffix_rate", rate)


def filter_urls(pages: DataFrame, labels: DataFrame, p: UrlParams = UrlParams()) -> DataFrame:
    """(page_id, url, score, keep) of every page."""
    split = parts(pages)
    feats, names = features(split, suffix_shares(split))
    model = train(feats, names, labels, p)
    s = F.when(F.col("u").isNotNull(), score(model))
    out = rated(feats, model).select("page_id", "url", s.alias("score"))
    return out.select("page_id", "url", F.round("score", 6).alias("score"), F.coalesce(F.col("score") <= F.lit(model.threshold), F.lit(False)).alias("keep"))


def labelled_by_host(pages: DataFrame, families: tuple[str, ...] = BLOCKED) -> DataFrame:
    """(url, label): 1 where the host belongs to a blocked family, else 0."""
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))
    blocked = F.lit(False)
    for f in families:
        blocked = blocked | host.contains(f)
    return pages.where(F.col("url").isNotNull()).select("url", blocked.cast("int").alias("label"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL with its score and whether it is kept."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, labelled_by_host(pages))
