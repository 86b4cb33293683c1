"""Classification cascades: first rule that applies wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.profiles import LATIN, Gates, ScriptProfile

SAFE, OCR = "safe", "ocr_needed"


def text_stats(docs: DataFrame, c: str = "text", p: ScriptProfile = LATIN) -> DataFrame:
    """``docs`` with chars, script_ratio, mark_chars, private_use, stray_controls of a text column; null text counts as empty."""
    t = F.coalesce(F.col(c), F.lit(""))
    return docs.withColumns(
        {
            "chars": F.length(t),
            "script_ratio": T.script_ratio(t, p),
            "mark_chars": T.mark_letters(t, p),
            "private_use": T.private_use_in_words(t),
            "stray_controls": T.stray_controls(t),
        }
    )


def extraction_status(chars_per_page: Column, presentation: Column, empty_ratio: Column, error: Column, g: Gates = Gates()) -> Column:
    """Of a document whose pages were read; the inputs are rounded already."""
    return (
        F.when(error.isNotNull(), "error")
        .when(F.coalesce(chars_per_page, F.lit(0.0)) < g.min_chars_per_page, "needs_ocr")
        .when(presentation > g.max_presentation_ratio, "extracted_suspect")
        .when(empty_ratio > g.max_empty_ratio, "extracted_partial")
        .otherwise("extracted")
    )


def extraction_class(status: Column, g: Gates = Gates()) -> Column:
    """struct(class, reason) from a status and the columns of text_stats."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rules = [
        (status == "needs_ocr", "no text layer"),
        (status == "extracted_suspect", "shaped glyphs"),
        (status == "extracted_partial", "mostly empty pages"),
        (status == "error", "unreadable"),
        (zero("chars") < g.min_chars, "too short"),
        (zero("script_ratio") < g.min_script_ratio, "other script"),
        ((zero("chars") >= g.long_chars) & (zero("mark_chars") / F.col("chars") < g.min_mark_ratio), "other language"),
        (zero("private_use") > 0, "private use in words"),
        (zero("stray_controls") > 0, "stray controls"),
    ]
    cls, reason = F.lit(SAFE), F.lit("clean")
    for test, why in reversed(rules):
        cls, reason = F.when(test, OCR).otherwise(cls), F.when(test, why).otherwise(reason)
    return F.struct(cls.alias("class"), reason.alias("reason"))


def ocr_class(g: Gates = Gates()) -> Column:
    """Of a compiled OCR document; the marks are measured against letters of the script, not all characters."""
    marks = F.col("mark_chars") / F.greatest(F.col("script_chars"), F.lit(1))
    return (
        F.when(F.col("skipped") | (F.col("pages_rejected") > F.col("pages_ok")), "rejected")
        .when(F.col("chars") < g.min_chars, "low_text")
        .when(F.col("script_ratio") < g.min_script_ratio, "other_script")
        .when(marks < g.min_ocr_mark_ratio, "other_language")
        .otherwise("accepted")
    )


def script_class(c: Column) -> Column:
    """First classifier: by counts of Arabic and Latin letters and strong marks."""
    ar = T.count(c, r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}]")
    lat = T.count(c, "[A-Za-z]")
    strong = T.count(c, r"[\x{06CE}\x{06C6}\x{06A4}\x{0695}\x{06B5}]")
    return F.when(ar + lat < 200, "image_only_or_empty").when(ar > lat, F.when(strong / F.greatest(ar, F.lit(1)) > 0.005, "kurdish").otherwise("arabic")).otherwise("latin")


def language_class(c: Column) -> Column:
    """Second classifier: letter and word scores; equal counts of both scripts stay unknown, equal scores are Kurdish."""
    t = F.lower(c)
    ar, lat = T.count(t, r"[\x{0600}-\x{06FF}]"), T.count(t, "[a-z]")
    a_score = T.count(t, "[طظضصذثؤإأكية]") + 2 * T.count(t, r"(?U)\b(?:الله|الى|على|من|في|ال)")
    k_score = T.count(t, "[کیڵڕەۆێڤگژچپ]")
    diacritics = T.count(t, "[êîûçş]")
    return (
        F.when((ar > lat) & (ar > 20), F.when(a_score > k_score, "arabic").otherwise("kurdish_arabic"))
        .when((lat > ar) & (lat > 20), F.when(diacritics > 3, "latin_kurdish").otherwise("other_latin"))
        .otherwise("unknown")
    )


def size_band(chars: Column) -> Column:
    return F.when(chars < 10_000, "small").when(chars < 50_000, "medium").otherwise("large")


def page_status(t: Column) -> Column:
    """Of a page's response: an exact marker, a prefix marker, text or nothing."""
    return F.when(t == "[NO_TEXT]", "no_text").when(t.startswith("[REJECTED"), "rejected").when(F.length(T.strip(F.coalesce(t, F.lit("")))) > 0, "ok").otherwise("empty")


def review_first(g: Gates = Gates()) -> Column:
    return (F.col("classification") != "accepted") | (F.col("unclear_marks") > g.max_unclear) | (F.col("completeness") < 1)


def trainable() -> Column:
    """Accepted, and complete after rounding."""
    return (F.col("classification") == "accepted") & (F.col("completeness") == 1.0)


def attachment(has_document: Column, media_kinds: list[Column]) -> Column:
    """A document that is none of the media kinds."""
    out = F.coalesce(has_document, F.lit(False))
    for k in media_kinds:
        out = out & ~F.coalesce(k, F.lit(False))
    return out


def sniff(content: Column) -> Column:
    """pdf, html or other, by the first 1,024 bytes."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    low = F.lower(F.regexp_replace(head, r"^\s+", ""))
    return F.when(head.contains("%PDF-"), "pdf").when(low.startswith("<!doctype html") | low.startswith("<html") | low.startswith("<head"), "html").otherwise("other")
