"""Quality rules: distribution divergence from language references.

Each document has two histograms: its characters by Unicode class, and its words
over the common words of its language (with one bin for all other words). The
reference of a language is the sum of the histograms of all its documents. A
document is kept unless the Jensen-Shannon distance (base 2, in [0, 1]) of a
histogram to its reference exceeds ``max_js + noise / sqrt(n)``, where the second
term allows for the sampling noise of n counts; each test applies only from a
minimum length of the document and of the reference.

The common words of a language are exactly the words whose share of its words is
at least ``phi``, so there are at most 1 / phi. One pass counts the words and characters
of each partition; the counts of a word are added up by the cluster, and only common words
of languages with a reference leave it.

Defined results: null, empty and short texts are kept with null distances (no
evidence); a null language forms a group of its own; an empty table gives an
empty result; repeated rows get equal results; texts of any length are counted whole. Only doc_id,
lang and text are read, whatever other columns there are.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.shared import stored, table

WORD = re.compile(r"[^\W\d_]+")
CLASSES = ("lower", "upper", "letter", "mark", "digit", "space", "sentence", "punctuation", "symbol", "other")
_SENTENCE = ".,;:!?'\"()-"
RESULT = "n_chars long, n_words long, js_chars double, js_words double"


@dataclass(frozen=True)
class QualityRules:
    """``phi``: least share of a common word. Thresholds are distances; lengths are in characters and words."""

    phi: float = 0.002
    max_js_chars: float = 0.17
    noise_chars: float = 1.2
    max_js_words: float = 0.17
    noise_words: float = 2.2
    min_chars: int = 100
    min_words: int = 50
    min_reference_words: int = 1000


def _class(cp: int) -> int:
    c = chr(cp)
    cat = unicodedata.category(c)
    if c in _SENTENCE:
        return 6
    if c.isspace():
        return 5
    first = {"Ll": 0, "Lu": 1}.get(cat)
    return first if first is not None else {"L": 2, "M": 3, "N": 4, "P": 7, "S": 8}.get(cat[0], 9)


_LUT: list[np.ndarray] = []


def char_histogram(text: str) -> np.ndarray:
    """Counts by class; beyond the basic plane every character counts as a symbol."""
    if not _LUT:
        _LUT.append(np.array([_class(i) for i in range(0x10000)] + [8], dtype=np.uint8))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(_LUT[0][np.minimum(points, 0x10000)], minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """sqrt of the Jensen-Shannon divergence (base 2) of two histograms of counts."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def counts(docs: DataFrame, block: int = 500_000) -> DataFrame:
    """(lang, word, n) over all of ``docs`` (lang, text); word is null for all words, and "#k" for characters of class k."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict = defaultdict(Counter)
        chars: dict = defaultdict(lambda: np.zeros(len(CLASSES), dtype=np.int64))

        def flush() -> pd.DataFrame:
            rows = [(lang, w, n) for lang, c in words.items() for w, n in c.items()]
            rows += [(lang, None, sum(c.values())) for lang, c in words.items()]
            rows += [(lang, f"#{k}", int(n)) for lang, c in chars.items() for k, n in enumerate(c) if n]
            words.clear(), chars.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for pdf in it:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if text:
                    words[lang].update(WORD.findall(text.lower()))
                    chars[lang] += char_histogram(text)
            if sum(map(len, words.values())) > block:
                yield flush()
        yield flush()

    return docs.select("lang", "text").mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, rules: QualityRules) -> dict:
    """lang -> (words in all, character histogram, index of common words, word histogram)."""
    every = stored(counts(docs), "quality-counts")
    total = every.where(F.col("word").isNull() & (F.col("n") >= max(1, rules.min_reference_words))).select(F.col("lang").alias("g"), F.col("n").alias("total"))
    mine = every.join(total, F.col("lang").eqNullSafe(F.col("g"))).where(F.col("word").isNull() | F.col("word").startswith("#") | (F.col("n") >= F.lit(rules.phi) * F.col("total")))
    found: dict = defaultdict(dict)
    for r in mine.select("lang", "word", "n").collect():  # at most 1 / phi + 11 rows a language of min_reference_words
        found[r["lang"]][r["word"]] = r["n"]
    out = {}
    for lang, by in found.items():
        words = {w: n for w, n in sorted((w, n) for w, n in by.items() if w is not None and not w.startswith("#"))}
        chars = np.array([by.get(f"#{k}", 0) for k in range(len(CLASSES))], dtype=float)
        out[lang] = (by[None], chars, {w: i for i, w in enumerate(words)}, np.array([*words.values(), by[None] - sum(words.values())], dtype=float))
    return out


def measure(text: str | None, ref: tuple | None, rules: QualityRules) -> tuple:
    """(n_chars, n_words, js_chars, js_words) of one document."""
    if text is None:
        return None, None, None, None
    found = WORD.findall(text.lower())
    js_chars = js_words = None
    if ref is not None and ref[0] >= rules.min_reference_words:
        _, chars, index, hist = ref
        if len(text) >= max(1, rules.min_chars):
            js_chars = js_distance(char_histogram(text), chars)
        if len(found) >= max(1, rules.min_words):
            own, mine = np.zeros(len(hist)), Counter(found)
            for w in index.keys() & mine.keys():
                own[index[w]] = mine[w]
            own[-1] = len(found) - own[:-1].sum()
            js_words = js_distance(own, hist)
    return len(text), len(found), js_chars, js_words


def distances(lang: Column, text: Column, refs: dict, rules: QualityRules) -> Column:
    @F.pandas_udf(RESULT)
    def run(langs: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [measure(t, refs.get(g), rules) for g, t in zip(langs, texts)]
        return pd.DataFrame(rows, columns=["n_chars", "n_words", "js_chars", "js_words"]).astype({"n_chars": "Int64", "n_words": "Int64", "js_chars": "float64", "js_words": "float64"})

    return run(lang, text)


def keep(d: Column, rules: QualityRules) -> Column:
    """True unless a distance that applies exceeds its threshold."""
    over = lambda c, n, t, noise: F.coalesce(~F.isnan(d[c]) & (d[c] > F.lit(t) + F.lit(noise) / F.sqrt(d[n])), F.lit(False))
    return ~over("js_chars", "n_chars", rules.max_js_chars, rules.noise_chars) & ~over("js_words", "n_words", rules.max_js_words, rules.noise_words)


def op5_quality(spark: SparkSession, sf_dir: str, rules: QualityRules = QualityRules(), kept_only: bool = True) -> DataFrame:
    """The documents that the rules keep, with their measures; every document is measured."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    refs = references(docs, rules)
    out = docs.select("doc_id", "lang", distances(F.col("lang"), F.col("text"), refs, rules).alias("d"))
    out = out.withColumn("keep", keep(F.col("d"), rules))
    js = [F.when(~F.isnan(f"d.{c}"), F.round(f"d.{c}", 6)).alias(c) for c in ("js_chars", "js_words")]
    return (out.where("keep") if kept_only else out).select("doc_id", "lang", "d.n_chars", "d.n_words", *js, "keep")
