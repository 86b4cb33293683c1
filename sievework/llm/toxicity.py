"""Toxicity: counterfactual-regularised classifier.

A logistic model over the presence of words and word stems is trained on labelled documents
with the loss

    mean log-loss + l2 * |w|^2 + cf * mean (z(x) - z(x'))^2

where x' is the labelled text with every identity term swapped for another term of
its category, so that the score cannot rest on which group is mentioned. The
vocabulary is chosen by a chi-square test over the training rows; identity terms always
belong to it, so their weights are fitted and penalised rather than absent.

Training uses at most ``max_train_rows`` labelled rows (a hash sample, a
documented parameter); scoring reads every document whole.

Defined results: null or empty texts and texts without words score as the bias
and are never rejected; a document labelled more than once is used once with its
largest label; labels that are null or not 0/1 are ignored; with no label of
one class nothing is rejected. Repeated rows get equal scores. Added columns have
names of this module's own; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.shared import stored, table

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)

#: Categories of interchangeable terms for groups of people, in the languages of the corpus.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "gender_en": ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    "person_en": ("woman", "man", "girl", "boy"),
    "religion_en": ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    "religions_en": ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    "origin_en": ("african", "asian", "european", "american", "arab", "mexican", "chinese", "indian", "kurdish", "turkish"),
    "orientation_en": ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    "people_en": ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    "ability_en": ("disabled", "deaf", "blind", "autistic"),
    "gender_fr": ("femmes", "hommes", "filles", "garçons"),
    "religions_fr": ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    "origins_fr": ("africains", "asiatiques", "européens", "américains", "arabes", "chinois", "immigrés", "réfugiés"),
    "gender_de": ("frauen", "männer", "mädchen", "jungen"),
    "religions_de": ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    "origins_de": ("afrikaner", "asiaten", "europäer", "amerikaner", "araber", "chinesen", "einwanderer", "flüchtlinge"),
    "gender_es": ("mujeres", "hombres", "niñas", "niños"),
    "religions_es": ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    "origins_es": ("africanos", "asiáticos", "europeos", "americanos", "árabes", "chinos", "inmigrantes", "refugiados"),
}


def words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(found: set[str]) -> set[str]:
    """The words and, as ``stem*``, their leading letters, which are shared by inflected forms."""
    return found | {w[:k] + "*" for w in found for k in STEMS if len(w) > k}


def swaps(terms: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """term -> the next term of its category (a term of several categories keeps its first)."""
    out: dict[str, str] = {}
    for group in terms.values():
        for i, t in enumerate(group):
            out.setdefault(t, group[(i + 1) % len(group)])
    return out


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    threshold: float = float("inf")

    def score(self, text: str | None) -> float:
        return self.bias + sum(self.weights[w] for w in features(words(text)) & self.weights.keys())


def _dot(rows: np.ndarray, cols: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=w[cols], minlength=n)


def fit(examples: list[tuple[list[int], list[int], int]], n_features: int, l2: float, cf: float, steps: int = 400, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Minimise the loss by Adam; examples: (features of x, features of x', label)."""
    n = len(examples)
    y = np.array([e[2] for e in examples], dtype=float)
    r, c = (np.concatenate([np.full(len(e[0]), i) for i, e in enumerate(examples)]).astype(np.int64), np.concatenate([np.asarray(e[0], dtype=np.int64) for e in examples]))
    changed = [i for i, e in enumerate(examples) if e[0] != e[1]]
    dr = np.concatenate([np.full(len(examples[i][0]) + len(examples[i][1]), k) for k, i in enumerate(changed)] or [np.zeros(0)]).astype(np.int64)
    dc = np.concatenate([np.asarray(examples[i][0] + examples[i][1], dtype=np.int64) for i in changed] or [np.zeros(0, dtype=np.int64)])
    dv = np.concatenate([np.r_[np.ones(len(examples[i][0])), -np.ones(len(examples[i][1]))] for i in changed] or [np.zeros(0)])
    w, b = np.zeros(n_features), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(_dot(r, c, w, n) + b, -30, 30)))
        g = np.bincount(c, weights=(p - y)[r], minlength=n_features) / n + 2 * l2 * w
        if changed:
            gap = np.bincount(dr, weights=w[dc] * dv, minlength=len(changed))
            g += 2 * cf / len(changed) * np.bincount(dc, weights=gap[dr] * dv, minlength=n_features)
        step = np.r_[g, (p - y).mean()]
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
        move = rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The cut with the largest F1, set in the middle of the gap below it."""
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # ties can't be separated
    k = int(np.argmax(f1))
    return float(s[k]) if k + 1 == len(s) else float(s[k] + s[k + 1]) / 2


def labelled(docs: DataFrame, labels: DataFrame, max_train_rows: int, seed: int = 7) -> DataFrame:
    """(text, y) of at most ``max_train_rows`` labelled documents, those least by a seeded hash."""
    y = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    y = y.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_train_rows)
    if max_train_rows <= 1_000_000:
        y = F.broadcast(y)  # the limit bounds its size, so texts aren't shuffled for the join
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(y, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def train(docs: DataFrame, labels: DataFrame, terms: dict[str, tuple[str, ...]] = IDENTITY_TERMS, max_train_rows: int = 24_000, vocabulary: int = 4096, min_df: int = 3, min_chi: float = 10.0, l2: float = 1e-4, cf: float = 1.0) -> ToxicityModel:
    """Fit on labelled documents. Only word counts by class and vocabulary indices leave the executors."""
    rows = labelled(docs, labels, max_train_rows)

    def bags(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"words": [sorted(words(t)) for t in pdf["text"]], "y": pdf["y"]})

    bagged = stored(rows.mapInPandas(bags, "words array<string>, y int"), "toxic-train")
    total = {r["y"]: r["n"] for r in bagged.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return ToxicityModel()
    n1, n0 = float(total[1]), float(total[0])
    stems = [F.transform(F.filter("words", lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.left(w, F.lit(k)), F.lit("*"))) for k in STEMS]
    a, b = F.sum("y").cast("double"), (F.count("*") - F.sum("y")).cast("double")
    df = bagged.select(F.explode(F.array_distinct(F.flatten(F.array(F.col("words"), *stems)))).alias("word"), "y").groupBy("word").agg(a.alias("a"), b.alias("b")).where(F.col("a") + F.col("b") >= min_df)
    gap = F.col("a") / F.lit(n1) - F.col("b") / F.lit(n0)
    share = (F.col("a") + F.col("b")) / F.lit(n1 + n0)
    chi = gap * gap / (share * (1 - share + F.lit(1e-9)) * F.lit(1 / n1 + 1 / n0))
    swap = swaps(terms)
    chosen = [r["word"] for r in df.where(chi >= min_chi).orderBy(chi.desc(), "word").limit(vocabulary).collect()]
    vocab = {w: i for i, w in enumerate(dict.fromkeys([*chosen, *swap]))}

    def indexed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            x = [sorted(vocab[f] for f in features(set(ws)) if f in vocab) for ws in pdf["words"]]
            other = [sorted(vocab[f] for f in features({swap.get(w, w) for w in ws}) if f in vocab) for ws in pdf["words"]]
            yield pd.DataFrame({"x": x, "other": other, "y": pdf["y"]})

    got = bagged.mapInPandas(indexed, "x array<int>, other array<int>, y int").toPandas()
    examples = sorted((list(map(int, x)), list(map(int, o)), int(y)) for x, o, y in zip(got["x"], got["other"], got["y"], strict=True))
    w, bias = fit(examples, len(vocab), l2, cf)
    scores = np.array([bias + sum(w[j] for j in e[0]) for e in examples])
    weights = {t: float(w[i]) for t, i in vocab.items() if abs(w[i]) > 1e-9}
    return ToxicityModel(weights, float(bias), best_threshold(scores, np.array([e[2] for e in examples])))


def score(text: Column, model: ToxicityModel) -> Column:
    """Score of a text column; one Arrow batch at a time."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return run(text)


def is_toxic(text: Column, model: ToxicityModel) -> Column:
    """True where the text has words and scores over the threshold."""
    return F.coalesce((F.length(text) > 0) & (score(text, model) > F.lit(model.threshold)), F.lit(False))


def reject_toxic(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents that are not rejected; same columns."""
    return docs.where(~is_toxic(F.col("text"), train(docs, labels, **params)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier rejects, with their scores; every document is scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", F.length("text").alias("n_chars"), score(F.col("text"), model).alias("score"))
    return scored.where((F.col("n_chars") > 0) & (F.col("score") > F.lit(model.threshold))).select("doc_id", "score", F.lit(True).alias("toxic"))
