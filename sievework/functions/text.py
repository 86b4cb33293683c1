"""Text functions as Catalyst expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sievework.profiles import LATIN, ScriptProfile

#: Characters 0x80-0x9F that are cp1252 letters read as Latin-1, and the five that mean nothing.
_C1 = [chr(c) for c in range(0x80, 0xA0)]
_RECOVERED = {c: bytes([ord(c)]).decode("cp1252", "ignore") for c in _C1}
_ARABIC = r"[\x{0600}-\x{06FF}]"
#: Unicode's White_Space.
_BLANKS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Blanks of any kind off both ends, looked at from the ends only (a regex tries each place of the text)."""
    return F.btrim(c, F.lit(_BLANKS))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def class_count(c: Column, inside: str) -> Column:
    """Characters of a class (without its brackets), as what is left when runs of others go: far fewer matches than one a character."""
    return F.length(F.regexp_replace(c, f"[^{inside}]+", ""))


def recover_cp1252(c: Column) -> Column:
    """C1 characters to what cp1252 has there; those it lacks are dropped."""
    good = [k for k, v in _RECOVERED.items() if v]
    bad = [k for k, v in _RECOVERED.items() if not v]
    return F.translate(c, "".join(good + bad), "".join(_RECOVERED[k] for k in good))


def drop_private_use(c: Column) -> Column:
    """Private-use characters go unless both neighbours, as they were, are Arabic letters."""
    return F.regexp_replace(c, rf"(?<!{_ARABIC})\p{{Co}}|\p{{Co}}(?!{_ARABIC})", "")


def private_use_in_words(c: Column) -> Column:
    return count(c, rf"(?<={_ARABIC})\p{{Co}}(?={_ARABIC})")


def stray_controls(c: Column) -> Column:
    """Control characters other than line feed and tab."""
    return count(c, r"[\p{Cc}&&[^\n\t]]")


def unprintable(c: Column) -> Column:
    """Control, private-use and surrogate characters other than line feed and tab."""
    return count(c, r"[\p{Cc}\p{Co}\p{Cs}&&[^\n\t]]")


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark lacks."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def fold_letters(c: Column, source: str = "يكة", target: str = "یکە") -> Column:
    """Offline stand-in for an orthography library: letter for letter."""
    return F.translate(c, source, target)


def clean(c: Column) -> Column:
    """Compatibility fold, cp1252 recovery, private-use strip, letter folds; blank lines collapse and one line feed ends the text.

    A form feed is a blank line of its own, so it disappears.
    """
    t = fold_letters(drop_private_use(recover_cp1252(nfkc(c))))
    t = F.regexp_replace(t, r"(?U)(?m)^[^\S\n]+$", "")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.concat(strip(t), F.lit("\n"))


def script_letters(c: Column, p: ScriptProfile = LATIN) -> Column:
    return class_count(c, p.script)


def mark_letters(c: Column, p: ScriptProfile = LATIN) -> Column:
    return class_count(c, p.marks)


def script_ratio(c: Column, p: ScriptProfile = LATIN) -> Column:
    """Share of the letters that belong to the script, to 3 decimals, half to even; 0 without letters."""
    alpha = class_count(c, r"\p{L}")
    return F.when(alpha > 0, F.bround(script_letters(c, p) / alpha, 3)).otherwise(F.when(c.isNotNull(), F.lit(0.0)))


def presentation_ratio(c: Column) -> Column:
    """Share of shaped glyphs in Arabic text, to 3 decimals."""
    arabic = count(c, r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]")
    return F.when(arabic > 0, F.bround(count(c, r"[\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]") / arabic, 3)).otherwise(F.lit(0.0))


def pages(c: Column) -> Column:
    return F.split(c, r"\f")


def chars_per_page(page_texts: Column) -> Column:
    total = F.aggregate(page_texts, F.lit(0), lambda a, x: a + F.length(strip(x)))
    return F.bround(total / F.greatest(F.size(page_texts), F.lit(1)), 1)


def empty_page_ratio(page_texts: Column) -> Column:
    return F.bround(F.size(F.filter(page_texts, lambda x: strip(x) == "")) / F.greatest(F.size(page_texts), F.lit(1)), 3)


def paragraphs(c: Column, p: ScriptProfile = LATIN) -> Column:
    """Non-empty stripped paragraphs; a form feed ends one too."""
    parts = F.flatten(F.transform(F.split(c, r"\f"), lambda x: F.split(x, p.paragraph)))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def sentences(c: Column) -> Column:
    """Split after an end mark that blanks follow; no empty sentences."""
    return F.filter(F.split(c, r"\s(?<=[.!?؟۔।]\s)\s*"), lambda x: strip(x) != "")  # a blank first, then what stands before it: few places are looked at twice


def token_estimate(c: Column, chars_per_token: float = 1.6) -> Column:
    """At least 1; the offline fallback of a tokenizer."""
    return F.greatest(F.lit(1), F.bround(F.length(c) / F.lit(float(chars_per_token)), 0).cast("int"))


def word_tokens(c: Column) -> Column:
    """A second deterministic token count: words and single marks, at least 1."""
    return F.greatest(F.lit(1), count(c, r"(?U)\w+|[^\w\s]"))


def strip_code_fence(c: Column) -> Column:
    t = strip(c)
    return strip(F.regexp_replace(F.regexp_replace(t, r"^```[A-Za-z]*\s*\n?", ""), r"\n?```$", ""))


def latin_sample(c: Column, runs: int = 3, most: int = 160) -> Column:
    """The first runs of Latin letters, joined."""
    return F.substring(F.array_join(F.slice(F.regexp_extract_all(c, F.lit("([A-Za-z]+)"), 1), 1, runs), " | "), 1, most)


def marker_hits(c: Column, words: tuple[str, ...], word: str = r"\w") -> Column:
    """Hits of words that no character of ``word`` touches; what \\b takes for a letter depends on the JDK and its flags."""
    return count(c, rf"(?U)(?<![{word}])(?:{'|'.join(words)})(?![{word}])")


def leans(c: Column, p: ScriptProfile = LATIN, ratio: float = 1.5) -> Column:
    """struct(a, b, flag): hits of either marker list; the flag is set where a leads b by the ratio."""
    a, b = marker_hits(c, p.lean_a, p.word), marker_hits(c, p.lean_b, p.word)
    return F.struct(a.alias("a"), b.alias("b"), ((a > b * F.lit(ratio)) & (a > 0)).alias("flag"))


def intervals(c: Column, segments: Column) -> Column:
    """The [start, end) slices of a text, joined; segments: array of struct(start, end)."""
    return F.array_join(F.transform(segments, lambda s: c.substr(s["start"] + 1, s["end"] - s["start"])), "")


def document_id(source: Column, name: Column) -> Column:
    return F.substring(F.sha1(F.concat(source, F.lit("/"), name)), 1, 16)


def chunk_id(origin: Column, doc: Column, index: Column) -> Column:
    return F.format_string("%s-%s-%03d", origin, doc, index)


def hash01(key: Column, salt: str) -> Column:
    """A number in [0, 1] that depends on key and salt alone: the seeded draw of every sampling operator."""
    return F.conv(F.substring(F.sha1(F.concat(F.lit(salt + "|"), key.cast("string"))), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def cost(tokens_in: Column, tokens_out: Column, model: Column, rates: dict[str, tuple[float, float]], default_model: str, digits: int = 6) -> Column:
    """Dollars, to 6 decimals (or other ``digits``); a null model has the default's rate, an unknown one the dearest."""
    top = max(rates.values(), key=lambda r: r[0] + r[1])
    name = F.coalesce(model, F.lit(default_model))
    pick = lambda i: F.coalesce(F.create_map(*[F.lit(x) for m, r in rates.items() for x in (m, r[i])])[name], F.lit(top[i]))
    return F.bround((tokens_in * pick(0) + tokens_out * pick(1)) / F.lit(1e6), digits)
