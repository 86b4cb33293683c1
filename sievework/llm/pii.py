"""PII: format-preserving Feistel pseudonyms.

Candidates are found with one pass of a combined pattern over the whole text and
validated (Luhn, mod 97, octet and calendar ranges, country codes). Where a candidate
fails, its shorter forms and the other kinds are tried at its place before the search moves on
by one character. A valid value is reduced to what it says, apart from how it is
written: a date to its day, a phone number to country code and digits, an address or
a number to its digits and letters. That is permuted by a keyed, unbalanced Feistel network,
walking the cycle until the permuted value passes the same validation, and is
written in the layout of the original. The permutation is a bijection of the valid
values of a kind, so a value has the same pseudonym in every document and in every
layout, and whoever holds the key can invert it.

The key comes from the setting ``spark.sievework.pii.key``. Where it is unset, a random key
is drawn once a session: values stay linked within it, and nobody can invert them later.

Defined results: a null text stays null with no values and no kinds; an empty text stays
empty; values that fail validation are left as they are, and so are version numbers that look like
addresses; a date of two readings is read day first, and a phone number without a country code
as one of the North American plan; repeated rows get equal results; texts of any length are read whole.
All other columns are passed through untouched whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import secrets
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.shared import table

ROUNDS = 8
KEY_SETTING = "spark.sievework.pii.key"
KINDS = ("email", "iban", "card", "ssn", "phone", "ipv4", "date", "secret")
RESULT = "text string, n_pii int, kinds array<string>"

#: Alternatives in order of priority.
_EMAIL = r"(?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
_SECRET = r"""(?P<secret>\bAKIA[0-9A-Z]{16}\b|(?i:\b(?:token|password|passwd|secret|api_?key)["']?\s*[=:]\s*["']?)[A-Za-z0-9_\-]{8,})"""
_IBAN = r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
_DATE = r"(?P<date>(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\w-]))"
_IPV4 = r"(?P<ipv4>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))"
_CARD = r"(?P<card>(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|-[0-9]))"
_SSN = r"(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
_PHONE = r"(?P<phone>(?<![\w])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w]))"
PATTERN = re.compile("|".join((_EMAIL, _SECRET, _IBAN, _DATE, _IPV4, _SSN, _CARD, _PHONE)))
_SINGLE = {kind: re.compile(p) for kind, p in zip(("email", "secret", "iban", "date", "ipv4", "ssn", "card", "phone"), (_EMAIL, _SECRET, _IBAN, _DATE, _IPV4, _SSN, _CARD, _PHONE))}
TRIGGER = r"[0-9@]|AKIA|(?i:password|passwd|secret|token|api_?key)"
_TRIGGER = re.compile(TRIGGER)
_CARD_GROUPS = re.compile(r"[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[ -][0-9]{6}[ -][0-9]{5})")  # of cards that other digits follow
_VERSION = re.compile(r"(?i)(?:\b(?:v|ver|version|release|rev|build|section|chapter|kernel|firmware)\.?|§)\s*\Z")
#: Country calling codes: of one digit, of two, and all others that begin with 2-9 of three.
_CODES_1 = frozenset("17")
_CODES_2 = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_SECRET_VALUE = re.compile(r"[A-Za-z0-9_\-]{8,}\Z")
_EPOCH = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2100, 1, 1).toordinal() - _EPOCH


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _round(key: bytes, tweak: bytes, i: int, x: int, modulus: int) -> int:
    data = tweak + bytes((i,)) + x.to_bytes(max(1, (x.bit_length() + 7) // 8), "big")
    size = min(64, (modulus.bit_length() + 7) // 8 + 8)
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=size).digest(), "big") % modulus


def feistel(x: int, left: int, right: int, key: bytes, tweak: bytes, inverse: bool = False) -> int:
    """A keyed permutation of range(left * right), as an alternating Feistel network on (x // right, x % right)."""
    a, b = divmod(x, right)
    for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        sign = -1 if inverse else 1
        if i % 2 == 0:
            a = (a + sign * _round(key, tweak, i, b, left)) % left
        else:
            b = (b + sign * _round(key, tweak, i, a, right)) % right
    return a * right + b


def _mixed(radices: list[int]) -> tuple[int, int]:
    left = right = 1
    for r in radices[: len(radices) // 2]:
        left *= r
    for r in radices[len(radices) // 2 :]:
        right *= r
    return left, right


def permute_chars(value: str, key: bytes, kind: str, inverse: bool = False, letters: int = 26) -> str:
    """Permute digits among digits and letters among the first ``letters``; case and separators keep their places."""
    spots = [(i, 10 if c.isdigit() else letters) for i, c in enumerate(value) if c.isascii() and c.isalnum()]
    if not spots:
        return value
    radices = [r for _, r in spots]
    x = 0
    for i, r in spots:
        x = x * r + (ord(value[i]) - 48 if r == 10 else ord(value[i].lower()) - 97)
    tweak = f"{kind}|{''.join('d' if r == 10 else 'l' for r in radices)}|".encode()
    x = feistel(x, *_mixed(radices), key, tweak, inverse)
    out = list(value)
    for i, r in reversed(spots):
        x, d = divmod(x, r)
        out[i] = chr(48 + d) if r == 10 else chr((65 if value[i].isupper() else 97) + d)
    return "".join(out)


def _refill(shape: str, chars: str) -> str:
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _bare(value: str) -> str:
    return "".join(c for c in value if c.isalnum())


def _iban_ok(v: str) -> bool:
    b = _bare(v)
    return 15 <= len(b) <= 34 and int("".join(str(int(c, 36)) for c in b[4:] + b[:4])) % 97 == 1


def _iban(v: str, key: bytes, inverse: bool) -> str:
    b = _bare(v)
    body = permute_chars(b[4:], key, "iban" + b[:2], inverse)
    check = 98 - int("".join(str(int(c, 36)) for c in body + b[:2] + "00")) % 97
    return _refill(v, f"{b[:2]}{check:02d}{body}")


def _card_ok(v: str) -> bool:
    b = _bare(v)
    return 13 <= len(b) <= 19 and luhn_digit(b[:-1]) == b[-1] and len(set(b)) > 1


def _card(v: str, key: bytes, inverse: bool) -> str:
    b = _bare(v)
    body = b[0] + permute_chars(b[1:-1], key, "card" + b[0], inverse)
    return _refill(v, body + luhn_digit(body))


def _date_parts(v: str) -> tuple[dt.date, str] | None:
    layouts = ("%Y-%m-%d", "%Y/%m/%d") if v[4] in "-/" else ("%d/%m/%Y", "%m/%d/%Y") if v[2] == "/" else ("%d.%m.%Y",)
    for layout in layouts:
        try:
            d = dt.datetime.strptime(v, layout).date()
        except ValueError:
            continue
        if 0 <= d.toordinal() - _EPOCH < _DAYS:
            return d, layout
    return None


def _date(v: str, key: bytes, inverse: bool) -> str:
    """Days up to the 12th are permuted among themselves, so that a month-first date can be told from its layout before and after."""
    day, layout = _date_parts(v)
    x = day.toordinal() - _EPOCH
    while True:
        x = feistel(x, 271, 271, key, b"date|", inverse)
        if x < _DAYS:
            d = dt.date.fromordinal(_EPOCH + x)
            if (d.day > 12) == (day.day > 12):
                return d.strftime(layout)


def _ipv4(v: str, key: bytes, inverse: bool) -> str:
    x = 0
    for o in v.split("."):
        x = x * 256 + int(o)
    x = feistel(x, 1 << 16, 1 << 16, key, b"ipv4|", inverse)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def _ssn_ok(v: str) -> bool:
    a, g, s = v.split("-")
    return a not in ("000", "666") and a[0] != "9" and g != "00" and s != "0000"


def _phone_parts(v: str) -> tuple[str, str, list[int]] | None:
    """(country code, national digits, their places in ``v``); a trunk zero in brackets is no digit of the number."""
    trunk = {i + 1 for i in range(len(v) - 2) if v[i : i + 3] == "(0)"}
    spots = [i for i, c in enumerate(v) if c.isdigit() and i not in trunk]
    digits = "".join(v[i] for i in spots)
    code = "1"
    if v.startswith("+"):
        n = 1 if digits[:1] in _CODES_1 else 2 if digits[:2] in _CODES_2 else 3
        if digits.startswith("0"):
            return None
        code, digits, spots = digits[:n], digits[n:], spots[n:]
    return (code, digits, spots) if 6 <= len(digits) and len(code) + len(digits) <= 15 else None


def _phone(v: str, key: bytes, inverse: bool) -> str:
    code, digits, spots = _phone_parts(v)
    out = list(v)
    for i, c in zip(spots, permute_chars(digits, key, "phone" + code, inverse)):
        out[i] = c
    return "".join(out)


def _secret_head(v: str) -> str:
    return v[: 4 if v.startswith("AKIA") and len(v) == 20 else _SECRET_VALUE.search(v).start()]


def _secret(v: str, key: bytes, inverse: bool) -> str:
    n = len(_secret_head(v))
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in v[n:])
    return v[:n] + permute_chars(v[n:], key, "secret", inverse, 6 if hexadecimal else 26)


def _secret_walk(v: str, key: bytes, inverse: bool) -> str:
    """Walks on until the pseudonym is hexadecimal just where the value is, so that it can be inverted."""
    is_hex = lambda x: not re.search(r"[^0-9a-fA-F]", x[len(_secret_head(x)) :])
    kind, out = is_hex(v), _secret(v, key, inverse)
    while is_hex(out) != kind:
        out = _secret(out, key, inverse)
    return out


def _email(v: str, key: bytes, inverse: bool) -> str:
    """The name is permuted for its domain, and the domain but for its last label."""
    local, _, domain = v.rpartition("@")
    host, _, top = domain.rpartition(".")
    other = permute_chars(host, key, "domain|" + top.lower(), inverse)
    plain = (other if inverse else host).lower()
    return f"{permute_chars(local, key, f'email|{plain}.{top.lower()}', inverse)}@{other}.{top}"


#: kind -> (is the matched text a value of that kind, its permutation)
RULES: dict[str, tuple[Callable[[str], bool], Callable[[str, bytes, bool], str]]] = {
    "email": (lambda v: True, _email),
    "iban": (_iban_ok, _iban),
    "card": (_card_ok, _card),
    "ssn": (_ssn_ok, lambda v, key, inv: permute_chars(v, key, "ssn", inv)),
    "phone": (lambda v: _phone_parts(v) is not None, _phone),
    "ipv4": (lambda v: all(len(o) == len(str(int(o))) and int(o) < 256 for o in v.split(".")), _ipv4),
    "date": (lambda v: _date_parts(v) is not None, _date),
    "secret": (lambda v: True, _secret_walk),
}


def pseudonym(value: str, kind: str, key: bytes, inverse: bool = False) -> str:
    """The pseudonym of a valid value, or with ``inverse`` the value of a pseudonym."""
    valid, permute = RULES[kind]
    while True:
        value = permute(value, key, inverse)
        if valid(value):
            return value


def scrub(text: str | None, key: bytes, inverse: bool = False, memo: dict | None = None) -> tuple[str | None, int, list[str]]:
    """(text with pseudonyms, number of values, sorted kinds)."""
    if not text or not _TRIGGER.search(text):
        return text, 0, []
    memo = {} if memo is None else memo
    kinds: list[str] = []
    out: list[str] = []
    done = at = 0
    while m := PATTERN.search(text, at):
        found = _valid(text, m.start(), m.lastgroup, m.group())
        if found is None:
            at = m.start() + 1
            continue
        kind, v = found
        if (kind, v) not in memo:
            memo[kind, v] = pseudonym(v, kind, key, inverse)
        out += [text[done : m.start()], memo[kind, v]]
        done = at = m.start() + len(v)
        kinds.append(kind)
    return "".join([*out, text[done:]]), len(kinds), sorted(set(kinds))


def _valid(text: str, at: int, kind: str, v: str) -> tuple[str, str] | None:
    """(kind, value) of what is valid at a place: the match itself, then its shorter forms, then other kinds with theirs."""
    if _accepted(text, at, kind, v):
        return kind, v
    for other, pattern in _SINGLE.items():
        m = pattern.match(text, at)
        while m:
            short = m.group()
            if (other, short) != (kind, v) and _ends(text, m.end()) and _accepted(text, at, other, short) and (other != "card" or _CARD_GROUPS.fullmatch(short)):
                return other, short
            m = pattern.match(text, at, m.end() - 1) if other in ("iban", "card") else None
    return None


def _ends(text: str, at: int) -> bool:
    """Whether no word and no hyphenated number goes on here."""
    return not re.match(r"\w|-[0-9]", text[at : at + 2])


def _accepted(text: str, at: int, kind: str, v: str) -> bool:
    return RULES[kind][0](v) and not (kind == "ipv4" and _VERSION.search(text[max(0, at - 16) : at]))


def scrubbed(text: Column, key: str, memo_size: int = 50_000) -> Column:
    """struct(text, n_pii, kinds) of a text column; one Arrow batch at a time. Texts without any trigger stay in the JVM."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        rows = []
        for t in texts:
            if len(memo) > memo_size:
                memo.clear()
            rows.append(scrub(t, secret, memo=memo))
        return pd.DataFrame(rows, columns=["text", "n_pii", "kinds"])

    done = run(F.when(text.rlike(TRIGGER), text))
    none = F.array().cast("array<string>")
    return F.struct(F.coalesce(done["text"], text).alias("text"), F.coalesce(done["n_pii"], F.lit(0)).alias("n_pii"), F.coalesce(done["kinds"], none).alias("kinds"))


def session_key(spark: SparkSession) -> str:
    """The key of the setting, or one drawn for this session."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced; same rows, same columns."""
    return docs.withColumn(text_col, scrubbed(F.col(f"`{text_col}`"), key)["text"])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonymised text, the number of values replaced and their kinds."""
    docs = table(spark, sf_dir, "documents")
    done = docs.select("doc_id", scrubbed(F.col("text"), session_key(spark)).alias("r"))
    return done.select("doc_id", "r.text", "r.n_pii", "r.kinds")
