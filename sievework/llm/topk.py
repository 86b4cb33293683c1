"""Exact top-k search: pivot-table elimination.

A stated set of query rows is searched against all rows; the k nearest others of each
by Euclidean distance are found exactly. Distances to many pivots are computed once
for every row. By the triangle inequality max over pivots of |d(q, p) - d(x, p)| is a
lower bound of d(q, x).

* Rows are grouped into blocks around their nearest pivot, once. A block keeps the range
  of its pivot distances, and so does each cell (the blocks of one pivot).
* The queries of a block first search that block, which gives an upper bound of their
  k-th distance. Cells whose range excludes a group of queries are left out at once (there
  are no more cells than pivots); for the others, blocks are joined by cell and excluded by
  their own ranges.
* Queries are sent to the blocks that are left; vectors move once, when blocks are made.
  In a block each query evaluates the candidates in the order of their bounds and stops
  exactly, when the next bound exceeds its k-th distance so far.

Bounds are compared with a slack of a millionth of the pivot distances, which covers the
rounding of single precision. Which vectors are pivots affects the work alone.

Defined results: rows with a null id, a null vector, a null or non-finite element
or another length than most vectors (ties: the greater length) are left out; a vector is not its own neighbour,
nor is a repeated row with its id; equal distances (to 9 decimals) are ranked by
id; where there are fewer than k others all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import grams
from sievework.shared import stored, table

_SLACK = 1e-6
_PACKED = "block long, cell long, ids binary, vectors binary, dists binary, asks binary, low array<double>, high array<double>"
_ASKED = "home long, cells array<long>, reach double, low array<double>, high array<double>, ids binary, vectors binary, dists binary, found_ids binary, found binary"
_RESULT = "id long, neighbour long, distance double"


@dataclass(frozen=True)
class TopKParams:
    k: int = 10
    pivots: int = 32
    block_rows: int = 2048
    group: int = 256


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part, one for each id."""
    v = F.col(f"`{vec_col}`")
    ok = F.coalesce(F.forall(v, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(e.cast("double"))), F.lit(False))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.cast("array<float>").alias("v"), ok.alias("ok")).where(F.col("id").isNotNull() & F.col("ok") & (F.size("v") > 0)).drop("ok")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (size["n"] if size else 0)).groupBy("id").agg(F.min("v").alias("v"))


def choose_pivots(rows: DataFrame, n: int) -> np.ndarray:
    """Up to n vectors, far apart, of those least by a hash of the id."""
    pool = rows.orderBy(F.xxhash64("id"), "id").limit(32 * n).toArrow()["v"].to_pylist()
    if not pool:
        return np.zeros((0, 0))
    x = np.unique(np.array(pool, dtype=np.float64), axis=0)
    chosen = [0]
    gap = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The row of the pivot table of each vector."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], axis=1)


def _slack(d: np.ndarray | float) -> np.ndarray | float:
    return _SLACK * np.abs(d) + 1e-9


def packed_blocks(rows: DataFrame, pivots: np.ndarray, p: TopKParams) -> DataFrame:
    """One row for each block: its ids, vectors and pivot distances (single precision), which ids ask, and the ranges of the distances. ``rows``: id, v, asks."""

    def cell(vs: pd.Series) -> pd.Series:
        if not len(vs):
            return pd.Series([], dtype="int64")
        return pd.Series(pivot_distances(np.array(vs.tolist(), dtype=np.float64), pivots).argmin(1))

    celled = stored(rows.withColumn("cell", F.pandas_udf(cell, "long")("v")), "topk-cells")
    parts = {r["cell"]: -(-r["n"] // p.block_rows) for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row for each pivot at most
    n_parts = F.coalesce(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])[F.col("cell")], F.lit(1)) if parts else F.lit(1)
    block = (F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), n_parts)).alias("block")

    def pack(t: pa.Table) -> pa.Table:
        x = np.array(t["v"].to_pylist(), dtype=np.float64)
        d = pivot_distances(x, pivots).astype(np.float32)
        return pa.table(
            {
                "block": t["block"].slice(0, 1),
                "cell": t["cell"].slice(0, 1),
                "ids": pa.array([t["id"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([x.astype(np.float32).tobytes()], pa.binary()),
                "dists": pa.array([d.tobytes()], pa.binary()),
                "asks": pa.array([t["asks"].to_numpy().astype(np.uint8).tobytes()], pa.binary()),
                "low": pa.array([d.min(0).astype(np.float64)], pa.list_(pa.float64())),
                "high": pa.array([d.max(0).astype(np.float64)], pa.list_(pa.float64())),
            }
        )

    return celled.select(block, "cell", "id", "v", "asks").groupBy("block").applyInArrow(pack, _PACKED)


class Search:
    """A group of queries with their k nearest so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, d: np.ndarray, k: int) -> None:
        self.ids, self.x, self.d, self.k = ids, x, d, k
        self.found_ids = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.full((len(ids), k), np.inf)
        self.evaluated = 0

    def visit(self, ids: np.ndarray, x: np.ndarray, d: np.ndarray) -> None:
        """Evaluate the rows of a block for each query in the order of their bounds, until the next bound is out of reach."""
        bound = np.zeros((len(self.ids), len(ids)), dtype=np.float32)
        for j in range(d.shape[1]):
            np.maximum(bound, np.abs(self.d[:, j, None] - d[None, :, j]), out=bound)
        bound -= _slack(np.maximum(self.d.max(1)[:, None], d.max(1)[None, :])).astype(np.float32) if d.shape[1] else 0
        bound[self.ids[:, None] == ids[None, :]] = np.inf
        order = np.argsort(bound, axis=1, kind="stable")
        at, step, alive = 0, 4 * self.k, np.arange(len(self.ids))
        while at < len(ids):
            alive = alive[bound[alive, order[alive, at]] <= self.found[alive, -1]]
            if not len(alive):
                return
            some = order[alive, at : at + step]
            here = bound[alive[:, None], some]
            inside = (here <= self.found[alive, -1:]) & np.isfinite(here)
            self._evaluate(alive, some, inside, ids, x)
            at, step = at + step, min(2 * step, 512)

    def _evaluate(self, rows: np.ndarray, some: np.ndarray, inside: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        dist = np.full(some.shape, np.inf)
        for lo in range(0, len(rows), 32):
            r, c = np.nonzero(inside[lo : lo + 32])
            dist[lo + r, c] = np.sqrt(((self.x[rows[lo + r]] - x[some[lo + r, c]]) ** 2).sum(1)).round(9)
        self.evaluated += int(inside.sum())
        all_d = np.concatenate((self.found[rows], dist), axis=1)
        all_ids = np.concatenate((self.found_ids[rows], np.where(inside, ids[some], np.iinfo(np.int64).max)), axis=1)
        o = np.lexsort((all_ids, all_d), axis=1)[:, : self.k]
        self.found[rows], self.found_ids[rows] = np.take_along_axis(all_d, o, 1), np.take_along_axis(all_ids, o, 1)


def _unpack(ids: bytes, vectors: bytes, dists: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    return i, np.frombuffer(vectors, dtype=np.float32).reshape(len(i), -1).astype(np.float64), np.frombuffer(dists, dtype=np.float32).reshape(len(i), -1)


def _of(batch: pa.RecordBatch, row: int, *columns: int) -> list:
    return [batch.column(c)[row].as_py() for c in columns]


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", asks: Column | None = None, p: TopKParams = TopKParams()) -> DataFrame:
    """(id, neighbour, rank, distance) of the k nearest of every row for whose ``id`` the condition ``asks`` holds (None: of all), among all rows."""
    rows = usable(vectors, id_col, vec_col).withColumn("asks", F.lit(True) if asks is None else F.coalesce(asks, F.lit(False)))
    pivots = choose_pivots(rows, p.pivots)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "id long, neighbour long, rank int, distance double")
    blocks = stored(packed_blocks(rows, pivots, p), "topk-blocks")
    sides = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(len(pivots))] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(len(pivots))]
    cells = [(r["cell"], np.array(r[1 : 1 + len(pivots)]), np.array(r[1 + len(pivots) :])) for r in blocks.groupBy("cell").agg(*sides).collect()]  # a row for each pivot at most

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r in range(b.num_rows):
                ids, x, d = _unpack(*_of(b, r, 1, 2, 3))
                own = np.flatnonzero(np.frombuffer(b.column(4)[r].as_py(), dtype=np.uint8))
                for lo in range(0, len(own), p.group):
                    q = own[lo : lo + p.group]
                    s = Search(ids[q], x[q], d[q], p.k)
                    s.visit(ids, x, d)
                    low, high, reach = d[q].min(0).astype(np.float64), d[q].max(0).astype(np.float64), float(s.found[:, -1].max())
                    near = [c for c, cl, ch in cells if (np.maximum(cl - high, low - ch) - _slack(np.maximum(high, ch)) <= reach).all()]
                    values = [[b.column(0)[r].as_py()], [near], [reach], [low], [high], [ids[q].tobytes()], [x[q].astype(np.float32).tobytes()], [d[q].tobytes()], [s.found_ids.tobytes()], [s.found.tobytes()]]
                    kinds = [pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in _ASKED.split(", ")])

    asked = stored(blocks.select("block", "ids", "vectors", "dists", "asks").mapInArrow(ask, _ASKED).withColumn("g", F.monotonically_increasing_id()), "topk-asked")
    x = blocks.select("block", "cell", F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    gap = lambda a, b: F.greatest(b["b_low"] - a["high"], a["low"] - b["b_high"]) - F.lit(_SLACK) * F.greatest(a["high"], b["b_high"]) - F.lit(1e-9)
    bound = F.array_max(F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("b_low", "b_high"), gap))
    visits = asked.select("g", "home", "reach", "low", "high", F.explode("cells").alias("cell")).join(x, "cell").where((F.col("home") != F.col("block")) & (bound <= F.col("reach"))).select("g", "block")
    queries = visits.join(asked.select("g", "ids", "vectors", "dists", "found"), "g").select("block", F.lit(1).alias("kind"), "ids", "vectors", "dists", "found")
    here = blocks.select("block", F.lit(0).alias("kind"), "ids", "vectors", "dists", F.lit(None).cast("binary").alias("found"))
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = here.unionByName(queries).repartition(n, "block").sortWithinPartitions("block", "kind")

    def results(ids: np.ndarray, found_ids: np.ndarray, found: np.ndarray, reach: np.ndarray) -> pa.RecordBatch:
        r, c = np.nonzero(np.isfinite(found) & (found <= reach[:, None]))
        return pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(found_ids[r, c]), pa.array(found[r, c])], names=["id", "neighbour", "distance"])

    def at_home(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r in range(b.num_rows):
                ids = np.frombuffer(b.column(0)[r].as_py(), dtype=np.int64)
                found = np.frombuffer(b.column(2)[r].as_py()).reshape(len(ids), -1)
                yield results(ids, np.frombuffer(b.column(1)[r].as_py(), dtype=np.int64).reshape(len(ids), -1), found, np.full(len(ids), np.inf))

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for b in it:
            for r in range(b.num_rows):
                if b.column(1)[r].as_py() == 0:
                    block = _unpack(*_of(b, r, 2, 3, 4))
                    continue
                s = Search(*_unpack(*_of(b, r, 2, 3, 4)), p.k)
                # the k-th distance at home is known; its neighbours are reported there
                reach = np.frombuffer(b.column(5)[r].as_py()).reshape(len(s.ids), -1)[:, -1]
                s.found[:, -1] = reach
                s.visit(*block)
                yield results(s.ids, s.found_ids, np.where(s.found_ids < np.iinfo(np.int64).max, s.found, np.inf), reach)

    home = asked.select("ids", "found_ids", "found").mapInArrow(lambda it: grams.rebatched(at_home(it)), _RESULT)
    away = met.mapInArrow(lambda it: grams.rebatched(search(it)), _RESULT)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour")).alias("rank")
    return home.unionByName(away).select("id", "neighbour", rank, "distance").where(F.col("rank") <= p.k)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours, among all embeddings, of every embedding whose id is divisible by 100."""
    out = nearest(table(spark, sf_dir, "embeddings"), asks=F.col("id") % 100 == 0)
    return out.select(F.col("id").alias("vec_id"), F.col("neighbour").alias("neighbour_id"), "rank", F.round("distance", 6).alias("distance"))
