"""Substring dedup: level-wise doubling.

Finds the passages of at least ``base`` words that occur in two documents or more,
exactly: a word is in such a passage if one of the windows of ``base`` words around it
occurs, as a run of words, in another document too.

* Level base/2: of all windows of that length only the anchors are compared, those
  with the least hash among the windows of some ``base``-word window. Equal windows of
  ``base`` words have equal anchors, so no repeat is lost. Anchors that occur in one
  document alone drop out.
* Level base: the windows around a surviving anchor are compared, all of them. They
  travel as runs with one anchor, keyed by it, so equal windows meet in one task; what
  comes back is which windows of a run repeat.
* Level 2L: a window is a candidate only if both its halves, at p and p + L, repeat at
  level L; its hash is made of theirs, so texts aren't read again. This goes on until
  no candidate survives.

Surviving anchors reach the second scan as a bitmap of at most ``max_bits``; a false
hit there only adds a candidate, so results do not depend on its size.

Defined results: null and empty texts and texts of fewer than ``base`` words have no
spans; rows with a null doc_id are left out; repeated rows of one doc_id are one
document, so they don't make a passage repeat, and their spans are reported once; an
empty table gives no spans. Words are compared in lower case, punctuation aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import grams
from sievework.shared import stored, table

BASE = 50
MAX_BITS = 27
_RUNS = "key long, doc_id long, start long, hashes binary"
_SPANS = "doc_id long, start long, hashes binary"


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n neighbours, by doubling."""
    if len(x) < n:
        return x[:0]
    m, w = x, 1
    while 2 * w <= n:
        m, w = np.minimum(m[:-w], m[w:]), 2 * w
    return np.minimum(m[: len(x) - n + 1], m[n - w : n - w + len(x) - n + 1])


def _documents(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, word hashes) of each text of at least ``base`` words."""
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lo, hi in grams.blocks(texts):
            words, _, _, at = grams.word_hashes(texts[lo:hi])
            for k in range(hi - lo):
                if at[k + 1] - at[k] >= base:
                    yield ids[lo + k], words[at[k] : at[k + 1]]


def _anchors(words: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the half windows, for each window of ``base`` words the least of those in it)."""
    half = grams.gram_hashes(words, base // 2)
    return half, sliding_min(half, base - base // 2 + 1)


def repeated_anchors(docs: DataFrame, base: int) -> DataFrame:
    """(anchor) of all anchors that occur in two documents or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, words in _documents(batches, base):
            a = np.unique(_anchors(words, base)[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), doc, np.int64)), pa.array(a.view(np.int64))], names=["doc_id", "anchor"])

    found = _rebatched(docs, run, "doc_id long, anchor long")
    return found.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")


def _rebatched(docs: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow of many small batches, joined into larger ones."""

    return docs.mapInArrow(lambda batches: grams.rebatched(run(batches)), schema)


def bitmap(anchors: DataFrame, max_bits: int) -> np.ndarray:
    """Bits set at the low bits of the anchors, in 64-bit words; its size follows their number up to 2^max_bits."""
    bits = min(max_bits, max(12, int(anchors.count() * 16).bit_length()))
    slot = F.col("anchor").bitwiseAND((1 << bits) - 1)
    rows = anchors.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))).alias("m")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[rows["w"].to_numpy()] = rows["m"].to_numpy().view(np.uint64)
    return out


def has_bit(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    slot = x & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _cut(keep: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of kept places with one key."""
    edge = np.concatenate(([True], (keep[1:] != keep[:-1]) | (key[1:] != key[:-1]), [True]))
    at = np.flatnonzero(edge)
    lo, hi = at[:-1], at[1:]
    return lo[keep[lo]], hi[keep[lo]]


def _run_batch(doc: int, base: int, key: np.ndarray, hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    blobs = [hashes[a:b].tobytes() for a, b in zip(lo, hi)]
    return pa.RecordBatch.from_arrays([pa.array(key[lo].view(np.int64)), pa.array(np.full(len(lo), doc, np.int64)), pa.array(base + lo), pa.array(blobs, pa.binary())], names=["key", "doc_id", "start", "hashes"])


def base_runs(docs: DataFrame, base: int, bits: np.ndarray) -> DataFrame:
    """Runs of windows of ``base`` words around the anchors that survive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, words in _documents(batches, base):
            _, anchor = _anchors(words, base)
            keep = has_bit(bits, anchor)
            if keep.any():
                yield _run_batch(doc, 0, anchor, grams.gram_hashes(words, base), *_cut(keep, anchor))

    return _rebatched(docs, run, _RUNS)


def longer_runs(spans: DataFrame, length: int) -> DataFrame:
    """Runs of windows of twice ``length`` whose halves repeat, of spans grouped by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for start, h in _merged(parts):
                    if len(h) > length:
                        key = sliding_min(h, length + 1)
                        twice = grams.mix(h[:-length] * np.uint64(0xD6E8FEB86659FD93) + h[length:])
                        yield _run_batch(doc, start, key, twice, *_cut(np.ones(len(key), dtype=bool), key))

    return _rebatched(spans, run, _RUNS)


def _merged(parts: list[dict]) -> Iterator[tuple[int, np.ndarray]]:
    """Adjacent runs of one document, joined: (start, hashes)."""
    start, held, end = 0, [], None
    for x in sorted(parts, key=lambda x: x["start"]):
        h = np.frombuffer(x["hashes"], dtype=np.uint64)
        if end is not None and x["start"] < end:
            if x["start"] + len(h) <= end:  # a repeated row
                continue
            h, x = h[end - x["start"] :], {"start": end}
        if end is not None and x["start"] == end:
            held.append(h)
        else:
            if held:
                yield start, np.concatenate(held)
            start, held = x["start"], [h]
        end = x["start"] + len(h)
    if held:
        yield start, np.concatenate(held)


def repeated_runs(runs: DataFrame) -> DataFrame:
    """The parts of the runs whose windows occur in two documents or more, grouped by document: (doc_id, parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            docs, starts = t["doc_id"].to_numpy(), t["start"].to_numpy()
            if not len(docs) or docs.min() == docs.max():
                return
            blob = t["hashes"].chunk(0)
            cuts = np.frombuffer(blob.buffers()[1], dtype=np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
            h = np.frombuffer(blob.buffers()[2], dtype=np.uint8)[cuts[0] : cuts[-1]].view(np.uint64)
            n = np.diff(cuts) // 8
            row = np.repeat(np.arange(len(n)), n)
            d = docs[row]
            order = np.lexsort((d, h))
            hs, ds = h[order], d[order]
            begin = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1])))
            stop = np.append(begin[1:], len(hs))
            keep = np.zeros(len(h), dtype=bool)
            keep[order] = np.repeat(ds[begin] != ds[stop - 1], stop - begin)
            lo, hi = _cut(keep, row)
            first = np.cumsum(n) - n
            blobs = [h[a:b].tobytes() for a, b in zip(lo, hi)]
            yield pa.RecordBatch.from_arrays([pa.array(docs[row[lo]]), pa.array(starts[row[lo]] + lo - first[row[lo]]), pa.array(blobs, pa.binary())], names=["doc_id", "start", "hashes"])

        for b in batches:
            keys = b.column(0).to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            # several keys are handled at once: equal windows have equal keys
            if len(keys) and key is not None and keys[0] != key and sum(x.nbytes for x in held) > 8 << 20:
                yield from close()
            if len(cut) > 2 and sum(x.nbytes for x in held) > 8 << 20:
                held.append(b.slice(0, int(cut[-2])))
                yield from close()
                b = b.slice(int(cut[-2]))
            if b.num_rows:
                held.append(b)
                key = b.column(0)[b.num_rows - 1].as_py()
        if held:
            yield from close()

    found = runs.repartition("key").sortWithinPartitions("key").mapInArrow(run, _SPANS)
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "hashes")).alias("parts"))


def levels(docs: DataFrame, base: int = BASE, max_bits: int = MAX_BITS) -> Iterator[tuple[int, DataFrame]]:
    """(length, repeated windows by document: (doc_id, parts of (start, hashes))) of each level that has any."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    anchors = stored(repeated_anchors(docs, base), "anchors")
    length, runs = base, base_runs(docs, base, bitmap(anchors, max_bits))
    while True:
        spans = stored(repeated_runs(runs), f"repeats-{length}")
        if spans.isEmpty():
            return
        yield length, spans
        runs, length = longer_runs(spans, length), 2 * length


def repeated_spans(docs: DataFrame, base: int = BASE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, start_word, end_word, longest): maximal spans of words in repeated passages; ``longest`` is the last level a window of the span survives."""
    tables = [
        spans.select("doc_id", F.lit(length).alias("length"), F.transform("parts", lambda p: F.struct(p["start"].alias("start"), (F.octet_length(p["hashes"]) / 8).cast("long").alias("n"))).alias("parts"))
        for length, spans in levels(docs, base, max_bits)
    ]
    schema = "doc_id long, start_word long, end_word long, longest int"
    if not tables:
        return docs.sparkSession.createDataFrame([], schema)
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    grouped = every.groupBy("doc_id").agg(F.collect_list(F.struct("length", "parts")).alias("levels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                starts: list[int] = []
                for lv in sorted(found, key=lambda x: x["length"]):
                    parts = sorted((p["start"], p["n"]) for p in lv["parts"])
                    if lv["length"] == base:
                        spans = []
                        for s, n in parts:
                            if spans and s <= spans[-1][1]:
                                spans[-1][1] = max(spans[-1][1], s + n - 1 + base)
                            else:
                                spans.append([s, s + n - 1 + base, base])
                        starts = [s[0] for s in spans]
                    else:
                        for k in np.unique(np.searchsorted(starts, [s for s, _ in parts], side="right") - 1):
                            spans[k][2] = lv["length"]
                out += [(doc, *s) for s in spans]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "start_word", "end_word", "longest"])

    return grouped.mapInArrow(run, schema)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of 50 words or more that occurs in several documents, as word positions [start_word, end_word)."""
    return repeated_spans(table(spark, sf_dir, "documents"))
