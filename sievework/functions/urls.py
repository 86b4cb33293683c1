"""URL functions as Catalyst expressions; relative links need the standard library."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

TRACKING = ("fbclid", "gclid", "m", "replytocom", "share", *(f"utm_{x}" for x in ("campaign", "content", "medium", "source", "term")))
DOCUMENT_ENDINGS = ("pdf", "doc", "docx", "epub", "odt", "rtf", "txt", "zip", "rar", "djvu")
SKIPPED_ENDINGS = ("jpg", "jpeg", "png", "gif", "svg", "webp", "css", "js", "ico", "mp3", "mp4", "woff", "woff2")


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^\s+|\s+$", ""), r"#.*$", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def host(url: Column) -> Column:
    """Lower case, without the ports 80 and 443 whatever the scheme."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r":(?:80|443)$", "")


def path(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def query(url: Column) -> Column:
    """Without tracking parameters, in order; names and values are decoded as a form's and encoded again, each with its equals sign."""
    parts = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    value = lambda x: F.when(F.instr(x, "=") > 0, F.substr(x, F.instr(x, "=") + 1)).otherwise("")
    pairs = F.transform(parts, lambda x: F.struct(form_decoded(F.substring_index(x, "=", 1)).alias("k"), form_decoded(value(x)).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING))
    return F.array_join(F.transform(kept, lambda p: F.concat(form_encoded(p["k"]), F.lit("="), form_encoded(p["v"]))), "&")


def form_decoded(c: Column) -> Column:
    """Plus signs to blanks and escapes to characters; a percent sign that escapes nothing stays."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def form_encoded(c: Column) -> Column:
    """Letters, digits and _ . - ~ as they are, blanks as plus signs, all else escaped."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalise(url: Column, force_http: bool = False) -> Column:
    """One form for one page; null unless http or https."""
    u = without_fragment(url)
    q = query(u)
    s = F.lit("http") if force_http else scheme(u)
    return F.when(scheme(u).isin("http", "https"), F.concat(s, F.lit("://"), host(u), path(u), F.when(q == "", "").otherwise(F.concat(F.lit("?"), q))))


def _ends(url: Column, endings: tuple[str, ...]) -> Column:
    return F.lower(url).rlike(r"\.(?:" + "|".join(endings) + r")(?:[?#]|$)")


def is_document(url: Column) -> Column:
    return _ends(url, DOCUMENT_ENDINGS)


def is_skipped(url: Column) -> Column:
    return _ends(url, SKIPPED_ENDINGS)


def in_scope(url: Column, domain: str) -> Column:
    return (host(url) == domain) | host(url).endswith("." + domain)


def kind(url: Column, domain: str) -> Column:
    """skip, then document (of any domain), then page (in scope), else outside."""
    return F.when(is_skipped(url), "skip").when(is_document(url), "document").when(in_scope(url, domain), "page").otherwise("outside")


def file_name(url: Column) -> Column:
    """The decoded last part of the path with other than word characters as _, at most 150 long, .bin without ending, and a hash of the URL before it."""
    base = F.regexp_replace(F.regexp_extract(path(without_fragment(url)), r"([^/]*)/*$", 1), r"%(?![0-9A-Fa-f]{2})", "%25")
    name = F.substring(F.regexp_replace(F.coalesce(F.nullif(F.try_url_decode(base), F.lit("")), F.lit("file")), r"(?U)[^\w.\-]+", "_"), 1, 150)
    name = F.when(name.rlike(r"(?U)\.\w{1,5}$"), name).otherwise(F.concat(name, F.lit(".bin")))
    return F.concat(F.regexp_replace(name, r"(?U)\.\w{1,5}$", ""), F.lit("_"), F.substring(F.sha1(url), 1, 8), F.regexp_extract(name, r"(?U)(\.\w{1,5})$", 1))


def header_file_name(disposition: Column, url: Column) -> Column:
    """From a Content-Disposition header (the encoded form first), else from the path."""
    star = F.try_url_decode(F.nullif(F.regexp_extract(disposition, r"(?i)filename\*\s*=\s*[^']*''([^;]+)", 1), F.lit("")))
    plain = F.nullif(F.regexp_extract(disposition, r'(?i)filename\s*=\s*"?([^";]+)', 1), F.lit(""))
    return F.coalesce(star, plain, F.regexp_extract(path(url), r"([^/]+)/*$", 1))


def drive_link(url: Column) -> Column:
    """struct(kind, id) of a shared-drive link; null for other hosts."""
    rules = (("folder", r"/folders/([\w-]+)"), ("file", r"/file/d/([\w-]+)"), ("gdoc", r"/(?:document|spreadsheets|presentation)/d/([\w-]+)"), ("file", r"[?&]id=([\w-]+)"))
    out = F.struct(F.lit("unknown").alias("kind"), F.lit(None).cast("string").alias("id"))
    for name, pattern in reversed(rules):
        out = F.when(url.rlike(pattern), F.struct(F.lit(name).alias("kind"), F.regexp_extract(url, pattern, 1).alias("id"))).otherwise(out)
    return F.when(host(url).isin("drive.google.com", "docs.google.com"), out)


def direct_download(url: Column) -> Column:
    """Share links with dl=0 to dl=1."""
    return F.regexp_replace(url, r"([?&]dl=)0\b", "$11")


def prefixes(url: Column) -> Column:
    """Every prefix of host and path, as struct(depth, prefix)."""
    parts = F.concat(F.array(host(url)), F.filter(F.split(path(url), "/"), lambda x: x != ""))
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct((i - 1).alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("prefix")))


def links(html: Column) -> Column:
    """Targets of a, iframe, embed and object elements, as they stand."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<(?:a|iframe|embed|object)\b[^>]*?\s(?:href|src|data)\s*=\s*["']([^"']*)["']"""), 1), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def title(html: Column) -> Column:
    return F.nullif(F.substring(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"^\s+|\s+$", ""), 1, 300), F.lit(""))


@F.pandas_udf(ArrayType(StringType()))
def resolve(base: pd.Series, targets: pd.Series) -> pd.Series:
    """Relative links against their page; what can't be parsed is null."""

    def one(b, t):
        try:
            return urljoin(b, t)
        except ValueError:
            return None

    return pd.Series([None if ts is None else [one(b or "", t) for t in ts] for b, ts in zip(base, targets)])
