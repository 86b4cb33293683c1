"""N-gram Jaccard join: size-aware heavy-light join.

Every document is the set of its word n-grams (hashed to 64 bits; a text of fewer
than n words is one gram of all its words). All pairs of sets with Jaccard
similarity of at least ``t`` are found:

* Equal sets form a class, known by a signature of 99 bits and the size; a class takes
  part once, however many documents it has.
* A global order of the grams, frequent ones last, gives each set a prefix. Two
  light sets (fewer than ``boundary`` grams) that are similar share a pair of grams
  within their first s - ceil(t s) + 2, so light sets enumerate the 2-subsets of
  that prefix. Pairs with a heavy set share a gram within their first
  s - ceil(t s) + 1, and at least k within their first s - ceil(t s) + k. Heavy sets, and
  the light ones large enough to be similar to one, have inverted lists of that
  prefix with k = ``lead`` s; the lists are scanned with length and position bounds,
  and a pair is a candidate if k of them have both. The overlap o that two sets need follows from both sizes, so
  only those in the first s - o + k of either count: the later ones are the frequent ones, by which most meet by chance.
* The boundary minimises the postings plus the expected scans over all sizes that
  occur, from the counts of sets by size and of the list entries that their prefixes meet.
* Candidates are verified on the whole sets, which are sent once to each block of
  candidates and not once for each pair. Texts that no candidate needs stay where they are:
  a bitmap of ids (at most 2^``id_bits`` bits; a false hit only sends a text more) tells.

Crowds: many near copies of one text have quadratically many pairs, which would meet in
hundreds of lists each. Sets that share a band of four least grams with ``crowd_min`` others or
more are joined to crowds; two sets of one crowd are no candidates, and all pairs of
a crowd are verified by products of incidence matrices instead. Which sets form a crowd
(at most ``crowd_max`` ends, the largest bands first) decides only which way a pair is verified.

Skew: the list of a gram that ``split`` sets or more have is cut into blocks, and each
pair of blocks is a list of its own, on any reducer. Candidates are grouped by the least
signature near them, and a group of more than ``group_pairs`` is cut into pairs of
blocks likewise. Connected groups are found with aggregates and joins only.

The first pass over the texts gives signatures, counts by size and frequent grams
(any choice of those is right, as they only set the order; so their number is
bounded by ``hot_max``). Postings (a table of sets, 40 bits of each key
and a position) and pairs travel as one binary row for each task and reducer. There a set
is its code, 48 bits of the signature and the size rounded up to 12 binary digits; all
classes of one code are verified. Pairs that meet by chance grow with the square of the table;
they are sent as sorted distances in a few bytes each. The shuffle files of a step
are deleted as soon as its table is written.

Defined results: null and empty texts and texts without words are classes of their own
without links; rows with a null doc_id take no part; rows that repeat a doc_id are one
document, with the row of least signature among those that have words; an empty table
gives no rows. Extra columns of any name are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import shared
from sievework.llm import grams
from sievework.llm.substrings import bitmap, has_bit
from sievework.shared import table

_FLUSH = 1 << 19
_SUBS = 4  # a reducer scans its long lists in so many parts, to bound its memory
_PAIRS = 1 << 19
_HELD = 1 << 22  # pairs that a reducer combines before they travel
_SHARED = 64  # count from which a gram's list goes to the reducers for frequent grams
_SLICE = 512  # texts that are Python strings at a time
_HOT_BLOCK = 1 << 21
_LIGHT = 60_000  # a 2-subset in common is enough
_MOST = 30_000  # keys in common that are enough for sets of any size
_SIZE_BITS = 28
_SUBSET, _CROSS, _SIDE, _FAR = 0xFFFF, 0x8000, 0x4000, 0x3FFE  # a position is cut at _FAR, which only weakens its bound
_DOC, _HOT, _SIZE, _BLOCKS = range(4)
_POSTED = ("key", "code", "runs", "pos")
_CLOSE = 0.999  # bounds are weakened by more than the rounding of a code's size
_BANDS, _BAND = 12, 4
_EDGES = (np.arange(_BANDS * _BAND, dtype=np.uint64) * np.uint64((1 << 64) // (_BANDS * _BAND))).astype(np.uint64)
_CROWDED = 8  # grams from which a set can be in a crowd
_COLUMNS = 2048  # grams of an incidence matrix at a time
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class JoinParams:
    """``hot_min``: count in a block from which a gram is reported as frequent; ``hot_max``: frequent grams kept for the order."""

    n: int = 3
    t: float = 0.51
    hot_min: int = 2
    hot_max: int = 1 << 19
    scan_cost: float = 0.25
    lead: float = 0.04
    split: int = 1 << 15
    group_pairs: int = 1 << 18
    crowd_min: int = 16
    crowd_max: int = 1 << 21
    crowd_block: int = 1 << 10
    crowd_grams: int = 1 << 20
    id_bits: int = 26

    def __post_init__(self) -> None:
        if not 0.5 < self.t <= 1:
            raise ValueError("t must be over 0.5 and at most 1: similar sets must share two grams")

    def least(self, s: int) -> int:
        """Grams that a set of s shares with any similar one."""
        return math.ceil(self.t * s - 1e-9)

    def common(self, s: int) -> int:
        """Grams that a set of s shares with any similar one of its size or larger within their prefixes."""
        return max(1, int(self.lead * s))

    def prefix(self, s: int) -> int:
        return s - self.least(s) + self.common(s)


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here delete their shuffle files at once; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    with _freed(df.sparkSession):
        return shared.stored(df, name)


def among(ids: DataFrame, column: str, p: JoinParams) -> Callable[[Column], Column]:
    """A test whether an id may be one of ``ids``: true for all that are, and for few others unless there are over 2^``id_bits`` / 16; null for null."""
    bits = bitmap(ids.select(F.xxhash64(column).alias("anchor")), p.id_bits)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(has_bit(bits, h.to_numpy(np.int64).view(np.uint64)))

    return lambda c: F.when(c.isNotNull(), test(F.xxhash64(c)))


def signature(s: np.ndarray) -> tuple[int, int]:
    """(64-bit hash of a set of grams, 35 bits more and the size): what stands for the set."""
    if not len(s):
        return 0, 0
    sums = np.array([(s * np.uint64(0xA24BAED4963EE407) ^ (s >> np.uint64(29))).sum(dtype=np.uint64), ((s ^ (s >> np.uint64(31))) * np.uint64(0x9E6C63D0876A9A47)).sum(dtype=np.uint64)], dtype=np.uint64)
    h = grams.mix(sums)
    return int(h[:1].view(np.int64)[0]), (int(h[1]) >> 29) << _SIZE_BITS | len(s)


def code(sig: int, size: int) -> int:
    """48 bits of a signature, then four of an exponent and twelve of the size, rounded up."""
    e = max(0, size.bit_length() - 12)
    if -(-size >> e) > 0xFFF:
        e += 1
    return sig >> 16 << 16 | e << 12 | -(-size >> e)


def _sizes(codes: np.ndarray) -> np.ndarray:
    return (codes & 0xFFF) << (codes >> 12 & 0xF)


def bands(s: np.ndarray) -> list[int]:
    """Keys that near copies of a set mostly have some of in common: each is made of the least grams in four ranges (of an empty one, that of the next)."""
    least = s[np.searchsorted(s, _EDGES) % len(s)].reshape(_BAND, _BANDS)
    h = np.arange(_BANDS, dtype=np.uint64)
    for row in least:
        h = grams.mix(h * np.uint64(0x9FB21C651E98DF25) + row)
    return h.view(np.int64).tolist()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for b in batches:
        for lo in range(0, b.num_rows, _SLICE):
            yield b.column(0).slice(lo, _SLICE).to_pylist(), b.column(1).slice(lo, _SLICE).to_pylist()


def _edges(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def size_class(s: np.ndarray) -> np.ndarray:
    """Sizes up to 256 as they are, above in steps of a sixteenth of their power of two."""
    step = 1 << np.maximum(np.log2(np.maximum(s, 1)).astype(np.int64) - 4, 0)
    return np.where(s <= 256, s, s // step * step)


def _met(held: list[np.ndarray], p: JoinParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, count of each) of a block of sets, and by set (size, other entries in the lists that its prefix meets)."""
    every = np.concatenate(held)
    order = np.argsort(every)
    g = every[order]
    first = np.flatnonzero(_edges(g))
    count = np.diff(np.append(first, len(g)))
    own = np.empty(len(g), dtype=np.uint64)
    own[order] = np.repeat(count, count)
    size = np.array([len(s) for s in held])
    by_set = np.sort(np.repeat(np.arange(len(held), dtype=np.uint64) << np.uint64(32), size) | own) & np.uint64(0xFFFFFFFF)
    begin = np.cumsum(size) - size
    sums = np.concatenate(([0], np.cumsum(by_set.astype(np.float64) - 1)))
    prefix = size - np.ceil(p.t * size - 1e-9).astype(np.int64) + np.maximum(1, (p.lead * size).astype(np.int64))
    return g[first], count, size, sums[begin + np.minimum(prefix, size)] - sums[begin]


def survey(docs: DataFrame, p: JoinParams) -> DataFrame:
    """First pass over (doc_id, text): signatures, frequent grams, counts by size, as rows (kind, a, b, c, code, bands); the last two are those of a text."""

    def rows(code: np.ndarray | None = None, keys: list | None = None, **columns: np.ndarray) -> pa.RecordBatch:
        n = len(columns["a"])
        more = (pa.nulls(n, pa.int64()) if code is None else pa.array(code), pa.array(keys or [None] * n, pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns.values()), *more], names=[*columns, "code", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[int, np.ndarray] = {}
        held: list[np.ndarray] = []
        n_held = n_blocks = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal n_held, n_blocks
            g, n, size, met = _met(held, p)
            cls = size_class(size)
            for c in np.unique(cls):
                sizes[int(c)] = sizes.get(int(c), np.zeros(2)) + (np.sum(cls == c), met[cls == c].sum())
            hot = n >= p.hot_min
            held.clear()
            n_held, n_blocks = 0, n_blocks + 1
            if hot.any():
                yield rows(kind=np.full(hot.sum(), _HOT, np.int32), a=g[hot].view(np.int64), b=n[hot].astype(np.int64), c=np.zeros(hot.sum(), np.int64))

        for ids, texts in _texts(batches):
            sigs, keys = [], []
            for s in grams.gram_sets(texts, p.n):
                sigs.append(signature(s))
                keys.append(bands(s) if len(s) >= _CROWDED else None)
                if len(s):
                    held.append(s)
                    n_held += len(s)
                    if n_held >= _HOT_BLOCK:
                        yield from close()
            if ids:
                sig = np.array(sigs, np.int64)
                yield rows(np.array([code(x, y & ((1 << _SIZE_BITS) - 1)) for x, y in sigs], np.int64), keys, kind=np.full(len(ids), _DOC, np.int32), a=np.array(ids, np.int64), b=sig[:, 0].copy(), c=sig[:, 1].copy())
        if held:
            yield from close()
        if sizes:
            s = sorted(sizes)
            yield rows(kind=np.full(len(s), _SIZE, np.int32), a=np.array(s, np.int64), b=np.array([sizes[x][0] for x in s]).astype(np.int64), c=np.array([sizes[x][1] for x in s]).astype(np.int64))
        yield rows(kind=np.array([_BLOCKS], np.int32), a=np.array([n_blocks], np.int64), b=np.zeros(1, np.int64), c=np.zeros(1, np.int64))

    return docs.mapInArrow(run, "kind int, a long, b long, c long, code long, bands array<long>")


def boundary(p: JoinParams, sizes: dict[int, tuple[int, int]], blocks: int) -> int:
    """The size from which sets are heavy, of least cost; sizes: size class -> (sets, list entries met within a block)."""
    order = sorted(s for s in sizes if s > 1)
    light = {s: sizes[s][0] * (e := min(s, s - p.least(s) + 2)) * (e - 1) / 2 for s in order}
    lists = {s: sizes[s][0] * p.prefix(s) for s in order}

    def cost(x: int) -> float:
        heavy = sum(lists[s] + p.scan_cost * blocks * sizes[s][1] for s in order if s >= x)
        return heavy + sum(light[s] + (lists[s] if s >= p.least(x) else 0) for s in order if s < x)

    return min([2, *(s for s in order if s > 2), *(s + 1 for s in order[-1:])], key=lambda x: (cost(x), x))


def ordered(s: np.ndarray, hot: np.ndarray, hot_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a sorted set in the global order, its counts): grams that aren't frequent by hash, then the others by count and hash."""
    if not len(hot):
        return s, np.zeros(len(s), dtype=np.int32)
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    rank = np.where(hot[at] == s, hot_count[at], np.int32(0))
    o = np.argsort(rank, kind="stable")
    return s[o], rank[o]


def reducers(spark: SparkSession) -> list[int]:
    """For each shuffle partition, a number whose hash sends it there."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 24 * n, 1, 1).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    return sorted(r["id"] for r in rows)


def _packed(targets: np.ndarray, part: np.ndarray, key: np.ndarray, who: np.ndarray, pos: np.ndarray, m: np.ndarray, subs: int) -> Iterator[pa.RecordBatch]:
    """One row for each target and sub-part that ``part`` (target * subs + sub) has: a table of its sets with their numbers of postings, and keys and positions in their order."""
    order = np.argsort(part.astype(np.uint16 if len(targets) * subs < 65536 else np.uint32), kind="stable")
    cuts = np.searchsorted(part[order], np.arange(len(targets) * subs + 1, dtype=part.dtype))
    for i in np.flatnonzero(np.diff(cuts)):
        o = order[cuts[i] : cuts[i + 1]]
        new = _edges(who[o])
        at = np.flatnonzero(new)
        new |= (np.arange(len(o)) - np.repeat(at, np.diff(np.append(at, len(o))))) % 255 == 0
        first = np.flatnonzero(new)
        runs = np.diff(np.append(first, len(o))).astype(np.uint8)
        columns = (_narrow(key[o]), m[who[o[first]], 0], runs, pos[o])
        yield pa.RecordBatch.from_arrays([pa.array([targets[i // subs]]), pa.array([i % subs], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], names=["pid", "sub", *_POSTED])


def _narrow(key: np.ndarray) -> np.ndarray:
    """The upper five bytes of keys; lists that meet by what is lost only add candidates."""
    return (key >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]


def _widened(key: bytes) -> np.ndarray:
    out = np.zeros((len(key) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(key, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0].astype(np.uint64)


def _split(keys: np.ndarray, meta: tuple[np.ndarray, ...], count: np.ndarray, split: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Postings of long lists once for each pair of blocks of their list; ``meta``: code, set, position, frequent."""
    long = count >= split
    if not long.any():
        return keys, meta
    n = np.ones(len(keys), dtype=np.int64)
    n[long] = -(-count[long].astype(np.int64) // split)
    row = np.repeat(np.arange(len(keys)), n)
    other = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    mine = (grams.mix(meta[0][row].view(np.uint64)) % n[row].astype(np.uint64)).astype(np.int64)
    cell = np.minimum(mine, other) * (n[row] + 1) + np.maximum(mine, other) + 1
    k = np.where(n[row] > 1, grams.mix(keys[row] ^ grams.mix(cell.astype(np.uint64))), keys[row])
    sig, who, pos, frequent = (x[row] for x in meta)
    # a pair of different blocks holds two sides, of which only pairs across count; in (b, b) all do
    pos = np.where(mine != other, pos | np.uint16(_CROSS), pos)
    pos = np.where(mine > other, pos | np.uint16(_SIDE), pos)
    return k, (sig, who, pos, frequent)


def postings(docs: DataFrame, p: JoinParams, hot: tuple[np.ndarray, np.ndarray], heavy_from: int, pids: list[int]) -> DataFrame:
    """Second pass: for each reducer, packed postings (key, code, position or what marks a 2-subset)."""
    targets = np.array(pids, dtype=np.int64)
    border = p.least(heavy_from)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        meta: list[tuple[int, int, int]] = []
        held = 0
        seen: set = set()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            key, count = np.concatenate(keys), np.concatenate(counts)
            m = np.array(meta, dtype=np.int64)
            length = m[:, 1]
            who = np.repeat(np.arange(len(m)), length)
            pos = np.minimum(np.arange(len(key)) - np.repeat(np.cumsum(length) - length, length), _FAR).astype(np.uint16)
            pos[np.repeat(m[:, 2], length) == 1] = _SUBSET
            keys.clear(), meta.clear(), counts.clear()
            held = 0
            key, (_, who, pos, frequent) = _split(key, (m[who, 0], who, pos, count >= _SHARED), count, p.split)
            # copies of one text meet in the lists of many frequent grams: on an eighth of the reducers, more of their pairs are combined before they travel
            part = (key >> np.uint64(17)) % np.where(frequent, np.uint64(max(1, len(targets) // 8)), np.uint64(len(targets)))
            part = part * np.uint64(_SUBS + 1) + np.where(frequent, np.uint64(1) + (key >> np.uint64(7)) % np.uint64(_SUBS), np.uint64(0))
            yield from _packed(targets, part, key, who, pos, m, _SUBS + 1)

        for _, texts in _texts(batches):
            for s in grams.gram_sets(texts, p.n):
                n = len(s)
                if n < 2:
                    continue  # similar only to equal sets
                own = signature(s)
                if own in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(own)
                mine = code(own[0], n)
                o, rank = ordered(s, *hot)
                if n < heavy_from:
                    e = o[: min(n, n - p.least(n) + 2)]
                    i, j = np.triu_indices(len(e), 1)
                    keys.append(grams.mix(np.minimum(e[i], e[j]) * np.uint64(0x9FB21C651E98DF25) + np.maximum(e[i], e[j])))
                    counts.append(np.zeros(len(i), dtype=np.int32))
                    meta.append((mine, len(i), 1))
                    held += len(i)
                if n >= border:
                    keys.append(o[: p.prefix(n)])
                    counts.append(rank[: p.prefix(n)])
                    meta.append((mine, len(keys[-1]), 0))
                    held += len(keys[-1])
                if held >= _FLUSH:
                    yield from flush()
        if held:
            yield from flush()

    return docs.mapInArrow(run, "pid long, sub int, key binary, code binary, runs binary, pos binary")


def _scan(key: np.ndarray, own: np.ndarray, size: np.ndarray, pos: np.ndarray, crowd: np.ndarray, p: JoinParams, heavy_from: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs in the postings of whole lists that aren't of one crowd: (number of either set, what it counts); crowd: -1 for none."""
    subset = pos == _SUBSET
    key = (key << np.uint64(1)) | subset
    order = np.argsort(key)
    first = np.flatnonzero(_edges(key[order]))
    alone = np.diff(np.append(first, len(key))) == 1
    keep = np.ones(len(key), dtype=bool)
    keep[first[alone]] = False
    order = order[keep]
    if not len(order):
        return
    key, who, pos, crowd = key[order], (size[order].astype(np.uint64) << np.uint64(32)) | own[order].astype(np.uint64), pos[order], crowd[order]
    order = np.lexsort((who, key))
    order = order[_edges(key[order], who[order])]
    key, who, pos, crowd = key[order], who[order], pos[order], crowd[order]
    size, own = (who >> np.uint64(32)).astype(np.int64), (who & np.uint64(0xFFFFFFFF)).astype(np.int64)
    subset = pos == _SUBSET
    cross, side = pos & _CROSS != 0, pos & _SIDE
    pos = (pos & 0x3FFF).astype(np.int64)
    begins = np.flatnonzero(_edges(key))
    lengths = np.diff(np.append(begins, len(key)))
    end = np.repeat(begins + lengths, lengths)

    def similar(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        need = np.ceil(_CLOSE * p.t / (1 + p.t) * (size[i] + size[j]) - 1e-9)
        rest = np.minimum(size[i] - pos[i], size[j] - pos[j])
        # the first k grams in common are where ``need`` - k and more are to come
        first = rest > need - np.maximum(1, np.floor(p.lead * np.minimum(size[i], size[j])))
        ok = subset[i] | ((np.maximum(size[i], size[j]) >= heavy_from) & first & (np.minimum(pos[i], pos[j]) + rest >= need) & (~cross[i] | (side[i] != side[j])))
        a, b = i[ok], j[ok]
        return own[a], own[b], np.where(subset[a], _LIGHT, 1)

    crowded = np.repeat(np.logical_or.reduceat(crowd >= 0, begins), lengths)
    i, d = np.flatnonzero(~crowded), 0
    while len(i):
        d += 1
        i = i[i + d < end[i]]
        j = i + d
        near = size[i] >= _CLOSE * p.t * size[j]  # sizes ascend within a list
        i, j = i[near], j[near]
        if len(i):
            yield similar(i, j)

    # a list with crowds: each set with those behind its own crowd, the largest crowd first
    at = np.flatnonzero(crowded)
    if not len(at):
        return
    kind = np.where(crowd[at] >= 0, crowd[at], -1 - own[at])
    at = at[np.lexsort((kind, key[at]))]
    kind = np.where(crowd[at] >= 0, crowd[at], -1 - own[at])
    first = np.flatnonzero(_edges(key[at], kind))
    n = np.diff(np.append(first, len(at)))
    n = np.repeat(n, n)
    order = np.lexsort((kind, -n, key[at]))
    at, n, kind = at[order], n[order], kind[order]
    first = np.flatnonzero(_edges(key[at], kind))
    behind = np.repeat(np.append(first[1:], len(at)), n[first])
    lists = np.flatnonzero(_edges(key[at]))
    last = np.repeat(np.append(lists[1:], len(at)), np.diff(np.append(lists, len(at))))
    i, d = np.arange(len(at)), 0
    while len(i):
        i = i[behind[i] + d < last[i]]
        x, y = at[i], at[behind[i] + d]
        near = np.minimum(size[x], size[y]) >= _CLOSE * p.t * np.maximum(size[x], size[y])
        if near.any():
            yield similar(x[near], y[near])
        d += 1


class _Met:
    """Counts of pairs of sets; sets are numbered as they come, pairs are summed in sorted runs."""

    def __init__(self) -> None:
        self.sets = np.zeros(0, np.int64)
        self.code, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.raw: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_raw = 0

    def numbers(self, sets: np.ndarray) -> np.ndarray:
        """The number of each set."""
        known = len(self.sets)
        every = np.concatenate((self.sets, sets))
        _, first, back = np.unique(every, return_index=True, return_inverse=True)  # the place where each set is first
        new = first >= known
        number = first.copy()
        number[new] = known + np.arange(int(new.sum()))
        self.sets = np.concatenate((self.sets, every[first[new]]))
        return number[back[known:]]

    def add(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> None:
        self.raw.append(((np.minimum(a, b).astype(np.uint64) << np.uint64(32)) | np.maximum(a, b).astype(np.uint64), n))
        self.n_raw += len(a)
        if self.n_raw >= max(_PAIRS, len(self.code)):
            self.merge()

    def merge(self) -> None:
        code, n = (np.concatenate(c) for c in zip((self.code, self.n), *self.raw))
        self.raw, self.n_raw = [], 0
        order = np.argsort(code)
        code, n = code[order], n[order]
        one = np.flatnonzero(_edges(code))
        self.code, self.n = code[one], np.add.reduceat(n, one) if len(one) else n

    def take(self, targets: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs, which are forgotten: one row for each target that the lesser set's hash has."""
        self.merge()
        a, b = (self.code >> np.uint64(32)).astype(np.int64), (self.code & np.uint64(0xFFFFFFFF)).astype(np.int64)
        n = np.minimum(self.n, 0xFFFF).astype(np.uint16)
        self.code, self.n = self.code[:0], self.n[:0]
        a, b = self.sets[a], self.sets[b]
        a, b = np.minimum(a, b), np.maximum(a, b)
        part = (grams.mix(a.view(np.uint64)) % np.uint64(len(targets))).astype(np.int64)
        order = np.lexsort((b, a, part))
        cuts = np.searchsorted(part[order], np.arange(len(targets) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            o = order[cuts[i] : cuts[i + 1]]
            told = _told(a[o], b[o], n[o])
            yield pa.RecordBatch.from_arrays([pa.array([targets[i]]), *told.columns], names=["pid", *told.schema.names])


def _pressed(x: np.ndarray) -> bytes:
    """Numbers from 0 on, mostly small: bytes of equal weight side by side, compressed."""
    return len(x).to_bytes(4, "little") + pa.Codec("zstd").compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def _unpressed(x: bytes) -> np.ndarray:
    n = int.from_bytes(x[:4], "little")
    raw = pa.Codec("zstd").decompress(x[4:], decompressed_size=8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).view("<u8")[:, 0].astype(np.int64)


def _pressed_codes(x: np.ndarray) -> bytes:
    """Codes in ascending order: how far each signature is from the one before, and the sizes."""
    return _pressed(np.concatenate((np.diff(x >> 16, prepend=-(1 << 47)), x & 0xFFFF)))


def _unpressed_codes(x: bytes) -> np.ndarray:
    far, size = _unpressed(x).reshape(2, -1)
    return (np.cumsum(far) - (1 << 47)) << 16 | size


def _told(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """(code, runs, far, n) of pairs of codes a < b in ascending order: their sets, the number of pairs of each, and how far b is behind the one before."""
    sets, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    far = np.diff(ib, prepend=0)
    new = _edges(ia)
    far[new] = (ib - ia)[new]
    columns = (_pressed_codes(sets), _pressed(np.bincount(ia, minlength=len(sets))), _pressed(far), _pressed(n))
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in columns], names=["code", "runs", "far", "n"])


def _heard(code: bytes, runs: bytes, far: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (a, b, n) that ``_told`` had."""
    sets, runs, far = _unpressed_codes(code), _unpressed(runs), _unpressed(far)
    ia = np.repeat(np.arange(len(sets)), runs)
    sums = np.cumsum(far)
    first = np.cumsum(runs) - runs
    before = np.concatenate(([0], sums))[first]
    return sets[ia], sets[ia + sums - np.repeat(before, runs)], _unpressed(n)


def _summed(ia: np.ndarray, ib: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each pair once, with the sum of its counts."""
    o = np.lexsort((ib, ia))
    ia, ib, n = ia[o], ib[o], n[o]
    one = np.flatnonzero(_edges(ia, ib))
    return ia[one], ib[one], np.add.reduceat(n.astype(np.int64), one)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(pid, keys, code and number of postings of each set, positions) of all rows of one (pid, sub), for sorted batches."""
    at, parts = None, []
    for b in batches:
        for r in range(b.num_rows):
            part = b.column(0)[r].as_py(), b.column(1)[r].as_py()
            if at is not None and part != at:
                yield at[0], *(np.concatenate(x) for x in zip(*parts))
                parts.clear()
            at = part
            key, *others = (b.column(c)[r].as_py() for c in range(2, 2 + len(_POSTED)))
            parts.append((_widened(key), *(np.frombuffer(x, dtype=k) for x, k in zip(others, (np.int64, np.uint8, np.uint16)))))
    if at is not None:
        yield at[0], *(np.concatenate(x) for x in zip(*parts))


def _pairs_by_pid(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ia, ib, n) of all rows of one pid, for sorted batches of what _Met.take gives."""
    at, parts = None, []
    for batch in batches:
        for r in range(batch.num_rows):
            pid = batch.column(0)[r].as_py()
            if at is not None and pid != at:
                yield tuple(np.concatenate(x) for x in zip(*parts))
                parts.clear()
            at = pid
            parts.append(_heard(*(batch.column(c)[r].as_py() for c in range(1, 5))))
    if at is not None:
        yield tuple(np.concatenate(x) for x in zip(*parts))


def candidates(posted: DataFrame, p: JoinParams, heavy_from: int, pids: list[int], crowds: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Sets with those not of their crowd that have enough keys in common with them: (ia, ibs), each pair at its lesser set."""
    targets = np.array(pids, dtype=np.int64)
    members, crowd = crowds

    def crowd_of(sets: np.ndarray) -> np.ndarray:
        if not len(members):
            return np.full(len(sets), -1)
        at = np.minimum(np.searchsorted(members, sets), len(members) - 1)
        return np.where(members[at] == sets, crowd[at], -1)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, met = None, _Met()
        for pid, key, sets, runs, pos in _by_part(batches):
            if at is not None and pid != at:
                yield from met.take(targets)
                met = _Met()
            at = pid
            for pairs in _scan(key, *(np.repeat(x, runs) for x in (met.numbers(sets), _sizes(sets))), pos, np.repeat(crowd_of(sets), runs), p, heavy_from):
                met.add(*pairs)
                if len(met.code) >= _HELD:
                    yield from met.take(targets)
        yield from met.take(targets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _pairs_by_pid(batches):
            ia, ib, n = _summed(*cols)
            ok = n >= np.clip(np.floor(_CLOSE * p.lead * np.minimum(_sizes(ia), _sizes(ib))), 1, _MOST)
            ia, ib = ia[ok], ib[ok]
            first = np.flatnonzero(_edges(ia)) if len(ia) else np.zeros(0, np.int64)
            bounds = pa.array(np.append(first, len(ia)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ia[first]), pa.ListArray.from_arrays(bounds, pa.array(ib))], names=["ia", "ibs"])

    n = len(targets)
    met = posted.repartition(n, "pid").sortWithinPartitions("pid", "sub").mapInArrow(lambda b: grams.rebatched(meet(b), 1 << 20), "pid long, code binary, runs binary, far binary, n binary")
    return met.repartition(n, "pid").sortWithinPartitions("pid").mapInArrow(add, "ia long, ibs array<long>")


def crowds(found: DataFrame, p: JoinParams) -> tuple[np.ndarray, np.ndarray]:
    """(codes in ascending order, number of the crowd of each) of the sets in crowds."""
    one = stored(found.where(F.col("bands").isNotNull()).groupBy("code").agg(F.first("bands").alias("bands")), "ngram-bands")
    ends = one.select("code", F.explode("bands").alias("band"))
    hubs = stored(ends.groupBy("band").agg(F.count("*").alias("n"), F.min("code").alias("least")).where(F.col("n") >= p.crowd_min), "ngram-hubs")
    least, total = p.crowd_min, 0
    for r in hubs.groupBy("n").count().orderBy(F.desc("n")).toArrow().to_pylist():
        total += r["n"] * r["count"]
        if total > p.crowd_max:
            least = r["n"] + 1
            break
    rows = ends.join(hubs.where(F.col("n") >= least), "band").select("code", "least").distinct().toArrow()
    sets, at = np.unique(np.concatenate([rows[c].to_numpy() for c in ("code", "least")]), return_inverse=True)
    a, b = at[: rows.num_rows], at[rows.num_rows :]
    label, before = np.arange(len(sets)), None
    while before is None or (label != before).any():
        before, low = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
    return sets, label


def crowd_cells(spark: SparkSession, crowds: tuple[np.ndarray, np.ndarray], p: JoinParams) -> DataFrame:
    """(label, ba, bb, side, code): each set of a crowd in all pairs of blocks that its own is in; ba is below zero, which it isn't for candidates."""
    sets, crowd = crowds
    _, at, g = np.unique(crowd, return_inverse=True, return_counts=True)
    size = np.bincount(at, weights=_sizes(sets), minlength=len(g))
    blocks = np.maximum(-(-g // p.crowd_block), np.ceil(size / p.crowd_grams).astype(np.int64))[at]
    mine = (grams.mix(sets.view(np.uint64)) % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)
    rows = spark.createDataFrame(pa.table({"label": crowd, "code": sets, "blocks": blocks, "mine": mine}), "label long, code long, blocks long, mine long")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("label", (-1 - F.least("mine", "other")).alias("ba"), F.greatest("mine", "other").alias("bb"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "code")


class _Forest:
    """Union-find over indices."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x


def _verify(own: list[np.ndarray], partners: dict[int, list[int]], t: float, forest: bool) -> list[tuple[int, int, float, bool]]:
    """(a, b, Jaccard, does it connect what wasn't) of the similar pairs of one block; with ``forest`` only those that connect."""
    f = _Forest(len(own))
    size = np.array([len(s) for s in own])
    out = []
    for a, others in partners.items():
        s = own[a]
        for lo in range(0, len(others), 64):
            some = others[lo : lo + 64]
            if forest:
                some = [b for b in some if f.root(a) != f.root(b)]
                if not some:
                    continue
            cat = np.concatenate([own[b] for b in some])
            at = np.minimum(np.searchsorted(s, cat), len(s) - 1)
            lens = size[some]
            shared = np.add.reduceat((s[at] == cat).astype(np.int64), np.cumsum(lens) - lens)
            union = len(s) + lens - shared
            for k in np.flatnonzero(shared >= t * union - 1e-9):
                ra, rb = f.root(a), f.root(some[k])
                if ra != rb:
                    f.parent[ra] = rb
                if ra != rb or not forest:
                    out.append((a, some[k], shared[k] / union[k], ra != rb))
    return out


def _shared(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Number of grams that each of ``left`` has in common with each of ``right``, or else of ``left``."""
    every = [*left, *(right or [])]
    lens = np.array([len(x) for x in every], dtype=np.int64)
    out = np.zeros((len(left), len(left if right is None else right)), dtype=np.float32)
    if not out.size:
        return out
    _, at, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row, often = np.repeat(np.arange(len(lens)), lens), count > 1
    row, at = row[often[at]], (np.cumsum(often) - 1)[at[often[at]]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    for lo in range(0, int(often.sum()), _COLUMNS):
        some = slice(*np.searchsorted(at, (lo, lo + _COLUMNS)))
        m = np.zeros((len(lens), _COLUMNS), dtype=np.float32)
        m[row[some], at[some] - lo] = 1
        out += m[: len(left)] @ m[0 if right is None else len(left) :].T
    if right is None:
        np.fill_diagonal(out, lens)
    return out


def _crowd(own: list[np.ndarray], side: np.ndarray, n: np.ndarray, square: bool, t: float, forest: bool, counted: bool) -> tuple[np.ndarray, ...]:
    """(a, b, documents for a's count, for b's, Jaccard, does it connect) of the similar pairs of a block or of two; if ``counted``, those that connect, and sums with b = -1."""
    i = np.flatnonzero(side == 0)
    j = i if square else np.flatnonzero(side == 1)
    lens = np.array([len(s) for s in own])
    shared = _shared([own[x] for x in i], None if square else [own[x] for x in j]).astype(np.float64)
    union = lens[i][:, None] + lens[j][None] - shared
    ok = shared >= t * union - 1e-9
    if square:
        np.fill_diagonal(ok, False)
    label, tree = np.arange(len(own)), []
    for r in range(len(i)):
        c = np.flatnonzero(ok[r] & (label[j] != label[i[r]]))
        if len(c):
            roots, first = np.unique(label[j[c]], return_index=True)
            tree.extend((r, x) for x in c[first])
            label[np.isin(label, roots)] = label[i[r]]
    edge = np.zeros_like(ok)
    if tree:
        edge[tuple(np.array(tree).T)] = True
    r, c = np.nonzero(edge if forest or counted else np.triu(ok) if square else ok)
    a, b, jaccard, connects = i[r], j[c], shared[r, c] / union[r, c], edge[r, c]
    if not counted:
        return a, b, n[a], n[b], jaccard, connects
    sums = [(i, ok @ n[j])] if square else [(i, ok @ n[j]), (j, n[i] @ ok)]
    who, links = (np.concatenate(x) for x in zip(*sums))
    zero = np.zeros(len(a), np.int64)
    return (*(np.concatenate(x) for x in ((a, who), (b, np.full(len(who), -1)), (zero, np.zeros(len(who), np.int64)), (zero, links), (jaccard, np.zeros(len(who))), (connects, np.zeros(len(who), bool)))),)


@dataclass
class Join:
    """``sets``: (doc_id, sig, aux; null without words), one row a document; ``classes``: (sig, aux, rep, n) with the
    least doc_id and the number of documents; ``pairs``: similar classes as (x, y, nx, ny, jaccard, tree), x and y their
    rep; those with ``tree`` connect all that the others do, and with ``forest`` there are no others. If ``counted``, of the pairs in a
    crowd there are those that connect, with nx = ny = 0, and for x the sum of what they'd have in ny, with a null y."""

    sets: DataFrame
    classes: DataFrame
    pairs: DataFrame
    heavy_from: int


def similar(docs: DataFrame, p: JoinParams = JoinParams(), forest: bool = False, counted: bool = False) -> Join:
    """Join ``docs`` (doc_id, text) with itself."""
    with _freed(docs.sparkSession):
        return _similar(docs, p, forest, counted)


def _similar(docs: DataFrame, p: JoinParams, forest: bool, counted: bool) -> Join:
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    found = stored(survey(docs, p), "ngram-survey")
    own = F.min(F.when(F.col("c") > 0, F.struct(F.col("b").alias("sig"), F.col("c").alias("aux"), "code"))).alias("s")
    sets = stored(found.where(F.col("kind") == _DOC).groupBy(F.col("a").alias("doc_id")).agg(own).select("doc_id", "s.sig", "s.aux", "s.code"), "ngram-sets")
    classes = stored(sets.where("aux IS NOT NULL").groupBy("sig", "aux", "code").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "ngram-classes")
    hot_rows = found.where(F.col("kind") == _HOT).groupBy("a").agg(F.sum("b").alias("n")).orderBy(F.desc("n"), "a").limit(p.hot_max).toArrow()
    hot, count = hot_rows["a"].to_numpy().view(np.uint64), hot_rows["n"].to_numpy()
    o = np.argsort(hot)
    hot, count = hot[o], np.minimum(count[o], 1 << 30).astype(np.int32)
    by_size = {r["a"]: (r["n"], r["c"]) for r in found.where(F.col("kind") == _SIZE).groupBy("a").agg(F.sum("b").alias("n"), F.sum("c").alias("c")).collect()}
    n_blocks = found.where(F.col("kind") == _BLOCKS).agg(F.sum("a")).first()[0] or 0
    heavy_from = boundary(p, by_size, n_blocks)

    pids = reducers(docs.sparkSession)
    together = crowds(found, p)
    cand = stored(candidates(postings(docs, p, (hot, count), heavy_from, pids), p, heavy_from, pids, together), "ngram-candidates")
    keyed = _grouped(cand, crowd_cells(docs.sparkSession, together, p), docs, classes, p)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index, own, facts, partners = None, {}, [], [], {}

        def close() -> pa.RecordBatch:
            f = np.array(facts, dtype=np.int64)
            if at[1] < 0:
                a, b, nx, ny, j, tree = _crowd(own, f[:, 2], f[:, 1], -1 - at[1] == at[2], p.t, forest, counted)
            else:
                pairs = _verify(own, {k: [x for b in bs for x in index[b]] for a, bs in partners.items() for k in index[a]}, p.t, forest)
                a, b, j, tree = (np.array(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 4
                nx, ny = f[a, 1], f[b, 1]
            index.clear(), own.clear(), facts.clear(), partners.clear()
            cols = [pa.array(f[a, 0]), pa.array(f[b, 0], mask=b < 0), *(pa.array(x) for x in (nx, ny, j.astype(np.float64), tree.astype(bool)))]
            return pa.RecordBatch.from_arrays(cols, names=["x", "y", "nx", "ny", "jaccard", "tree"])

        for batch in batches:
            label, ba, bb, side, mine, rep, n = (batch.column(c).to_numpy() for c in range(7))
            bounds, ib = batch.column(7).offsets.to_numpy(), batch.column(7).values.to_numpy()
            for r in range(batch.num_rows):
                key = label[r], ba[r], bb[r]
                if at is not None and key != at:
                    yield close()
                at, me = key, int(mine[r])
                known = index.setdefault(me, [])
                if rep[r] not in (facts[k][0] for k in known):
                    known.append(len(own))
                    own.append(np.frombuffer(batch.column(8)[r].as_py(), dtype=np.uint64))
                    facts.append((rep[r], n[r], side[r]))
                if bounds[r + 1] > bounds[r]:
                    partners[me] = ib[bounds[r] : bounds[r + 1]].tolist()
        if at is not None:
            yield close()

    pairs = keyed.repartition("label", "ba", "bb").sortWithinPartitions("label", "ba", "bb").mapInArrow(lambda batches: grams.rebatched(check(batches)), "x long, y long, nx long, ny long, jaccard double, tree boolean")
    return Join(sets, classes, stored(pairs, "ngram-pairs"), heavy_from)


def _grouped(cand: DataFrame, cells: DataFrame, docs: DataFrame, classes: DataFrame, p: JoinParams) -> DataFrame:
    """(label, ba, bb, side, code, rep, n, ibs, grams): the candidates of each block with the sets they need, and the crowds' ``cells``.

    The label of a set is the least code among itself and those it is a candidate of: copies of one text share it, and are checked together.
    """
    each = F.explode("ibs").alias("o")
    pointed = cand.select(F.col("ia").alias("l"), each).select(F.col("o").alias("code"), "l")
    label = pointed.unionByName(cand.select(F.col("ia").alias("code"), F.col("ia").alias("l"))).groupBy("code").agg(F.min("l").alias("label"))
    label = stored(label, "ngram-labels")
    keyed = stored(cand.withColumnRenamed("ia", "code").join(label, "code"), "ngram-keyed")
    large = stored(keyed.groupBy("label").agg(F.sum(F.size("ibs")).alias("pairs")).where(F.col("pairs") > p.group_pairs), "ngram-large")
    key = ["label", "ba", "bb"]
    zero = F.lit(0).cast("long")
    whole = keyed.join(large, "label", "left_anti").select("label", zero.alias("ba"), zero.alias("bb"), "code", "ibs")
    cut = keyed.join(large, "label").withColumn("blocks", F.ceil(F.sqrt(F.col("pairs") / p.group_pairs)).cast("long"))
    block = lambda x: F.pmod(F.xxhash64(x), F.col("blocks"))
    cut = cut.select("label", "blocks", "code", each).withColumn("ba", block("code")).withColumn("bb", block("o"))
    cut = cut.groupBy(*key, "code").agg(F.collect_list("o").alias("ibs"))
    left = whole.unionByName(cut)
    none = F.array().cast("array<bigint>")
    right = left.select(*key, each).select(*key, F.col("o").alias("code")).distinct().withColumn("ibs", none)
    need = left.unionByName(right).withColumn("side", F.lit(0)).unionByName(cells.withColumn("ibs", none))
    need = stored(need.join(classes, "code").select(*key, "side", "code", "rep", "n", "ibs", "sig", "aux"), "ngram-need")
    docs = docs.where(among(need, "rep", p)(F.col("doc_id")))
    texts = need.join(docs, F.col("rep") == F.col("doc_id")).select(*need.columns, "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _SLICE):
                some = b.slice(lo, _SLICE)
                sets = list(grams.gram_sets(some.column(10).to_pylist(), p.n))
                sig = np.array([signature(s) for s in sets], np.int64).reshape(-1, 2)
                own = (sig[:, 0] == some.column(8).to_numpy()) & (sig[:, 1] == some.column(9).to_numpy())  # a doc_id may have other rows
                columns = [*some.columns[:8], pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*some.schema.names[:8], "grams"]).filter(pa.array(own))

    return texts.mapInArrow(hashed, "label long, ba long, bb long, side int, code long, rep long, n long, ibs array<long>, grams binary")


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the least vertex of the component of each vertex of ``edges`` (x, y), by large and small stars."""
    edges = stored(edges.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "cc")
    state = None
    while True:
        both = edges.union(edges.select("y", "x"))
        least = both.groupBy(F.col("x").alias("h")).agg(F.least(F.min("x"), F.min("y")).alias("m"))
        large = stored(both.where("y > x").join(least, F.col("x") == F.col("h")).select(F.col("y").alias("x"), F.col("m").alias("y")).distinct(), "cc")
        least = large.groupBy(F.col("x").alias("h")).agg(F.min("y").alias("m"))
        small = large.join(least, F.col("x") == F.col("h")).select("y", "m").where("y <> m").union(least)
        edges = stored(small.toDF("x", "y").distinct(), "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("x").alias("v"), F.col("y").alias("root"))
        state = now


def document_links(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """(doc_id, class_id, n_links) of each document: the least doc_id of all that similar pairs connect it with, and the number of other documents similar to it."""
    j = similar(docs, p, counted=True)
    ends = j.pairs.select(F.explode(F.array(F.struct(F.col("x").alias("v"), F.col("ny").alias("n")), F.struct(F.col("y").alias("v"), F.col("nx").alias("n")))).alias("e"))
    links = ends.where("e.v IS NOT NULL").groupBy("e.v").agg(F.sum("e.n").alias("links"))
    root = components(j.pairs.where("tree").select("x", "y"))
    known = j.classes.join(links, F.col("rep") == links["v"], "left").drop("v").join(root, F.col("rep") == root["v"], "left")
    known = known.select("sig", "aux", F.coalesce("root", "rep").alias("class_id"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = j.sets.where("aux IS NOT NULL").join(known, ["sig", "aux"]).select("doc_id", "class_id", "n_links")
    return out.unionByName(j.sets.where("aux IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def dropped(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """doc_id of every document that is not the least of its group; groups are what similar pairs connect."""
    j = similar(docs, p, forest=True)
    root = components(j.pairs.select("x", "y"))
    copies = j.sets.join(j.classes.where("n > 1").select("sig", "aux", "rep"), ["sig", "aux"]).where("doc_id > rep").select("doc_id")
    return copies.union(root.where("v > root").select("v"))


def one_of_each_group(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with the least doc_id of each group of similar documents; of rows of one doc_id one stays. Texts without words and null ids stay."""
    if "doc_id" not in docs.columns or "text" not in docs.columns:
        raise ValueError("docs needs doc_id and text")
    gone = stored(dropped(docs, p), "ngram-gone")
    may = F.coalesce(among(gone, "doc_id", p)(F.col("doc_id")), F.lit(False))
    out = docs.where(~may).unionByName(docs.where(may).join(gone, "doc_id", "left_anti").select(docs.columns))
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return out
    twice = out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return out.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(twice)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies (3-gram sets with a Jaccard similarity of at least 0.51) and the number of documents similar to it."""
    return document_links(table(spark, sf_dir, "documents"))
