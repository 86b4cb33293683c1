"""Vectorised word hashing shared by the operators that compare texts by runs of words.

Words are maximal runs of ASCII letters and digits and of non-ASCII characters in
the lower-cased text, i.e. what ``[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+`` matches. Many texts
are hashed at once on their UTF-8 bytes, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD_SQL = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BLOCK = 1 << 18

_IS_WORD = np.zeros(256, dtype=np.uint8)
_IS_WORD[48:58] = 1
_IS_WORD[97:123] = 1
_IS_WORD[128:] = 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p^0..p^n and their inverses modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.empty(size, dtype=np.uint64), np.empty(size, dtype=np.uint64)
        for out, base in ((up, _P), (down, _P_INV)):
            out[0] = 1
            done = 1
            while done < size:
                step = min(done, size - done)
                out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
        _POWERS[:] = [up, down]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its first byte, one past its last byte, words before each text and in all).

    Bytes count within the lower-cased texts laid end to end, each followed by one blank.
    """
    raw = ("\n".join(t.lower() if t else "" for t in texts) + "\n").encode("utf-8", "replace")
    b = np.frombuffer(raw, dtype=np.uint8)
    flag = _IS_WORD[b]
    edge = np.diff(flag, prepend=np.uint8(0)).view(np.int8)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(b))
    sums = np.empty(len(b) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts])
    # joined by line feeds that aren't in the texts' own lengths: byte where each text begins
    lengths = np.fromiter((len(t.lower().encode("utf-8", "replace")) if t and not t.isascii() else len(t or "") for t in texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    return words, starts, ends, np.searchsorted(starts, begins)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; only the first len - n + 1 are defined."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        out += words[k : len(words) - n + 1 + k] * np.uint64(factor)
    return mix(out)


def blocks(texts: list[str | None], size: int = _BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters, so that memory does not grow with the batch."""
    first = total = 0
    for i, t in enumerate(texts):
        total += len(t) if t else 0
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def gram_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; of fewer than n words, one gram of them all; of none, empty."""
    for a, z in blocks(texts):
        words, _, _, at = word_hashes(texts[a:z])
        grams = gram_hashes(words, n)
        for k in range(z - a):
            lo, hi = at[k], at[k + 1]
            if hi - lo >= n:
                own = np.sort(grams[lo : hi - n + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own
            elif hi > lo:
                yield gram_hashes(words[lo:hi], int(hi - lo))
            else:
                yield np.zeros(0, dtype=np.uint64)


def rebatched(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Small batches joined into ones of about ``size`` bytes."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
