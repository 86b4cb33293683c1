"""Best-fit packing: bin completion branch-and-bound.

Documents are packed whole into sequences of ``capacity`` tokens. One longer than
that is cut into full sequences and a remainder, which is packed like any other.

Documents are spread over blocks of about ``block_bins`` sequences by a hash. In a
block best-fit decreasing gives the incumbent. If it needs more sequences than the
lower bound (that of Martello and Toth), a depth-first search tries to do with fewer: it takes
the largest document left and enumerates the fillings of its sequence that no other
filling dominates, fullest first. A table of reachable sums leads the enumeration, so no
step of it is spent on a filling that is not there. A branch ends when its waste exceeds what
the incumbent less one sequence may waste; best fit of the rest may give better incumbents
on the way. The search ends at the bound, when it is exhausted, or after ``max_nodes``
fillings; the incumbent is then the result, so every document is packed whatever the limit.
``solve`` tells which of the three it was.

Defined results: null and empty texts have no tokens and are in no sequence;
repeated rows are packed as often as they occur; null doc_ids are packed and carried
as null; ties in length are broken by (doc_id, start); an empty table gives no
sequences; texts of any length are cut as above. Only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.mixing import token_count
from sievework.shared import stored, table

SEQUENCES = "bin_id string, doc_ids array<long>, starts array<long>, lengths array<int>, n_tokens int"


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    block_bins: int = 256
    max_nodes: int = 20_000
    seed: int = 5


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (indices of ``sizes``, which descend): each item goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room, -bin), ascending: the earliest of the fullest bins is last of its kind
    for i, n in enumerate(sizes):
        k = bisect_left(room, (n, -len(bins)))
        if k == len(room):
            b, free = len(bins), capacity
            bins.append([])
        else:
            free, b = room.pop(k)
            b = -b
        bins[b].append(i)
        if free > n:
            insort(room, (free - n, -b))
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs (L2 of Martello and Toth): items over half the capacity have bins of their own, and what they leave is less the larger K."""
    if not sizes:
        return 0
    asc = np.sort(np.array(sizes, dtype=np.int64))
    sums = np.concatenate(([0], np.cumsum(asc)))
    half = np.searchsorted(asc, capacity // 2, side="right")
    k = np.concatenate(([0], np.unique(asc[:half])))
    small = np.searchsorted(asc, k, side="left")  # items below K are left out
    large = np.maximum(np.searchsorted(asc, capacity - k, side="right"), half)  # items that nothing of K or more goes with
    room = (large - half) * capacity - (sums[large] - sums[half])
    more = np.maximum(0, -(-(sums[half] - sums[small] - room) // capacity))
    return int((len(asc) - half + more).max())


def fillings(sizes: list[int], counts: list[int], room: int, waste: int) -> Iterator[list[tuple[int, int]] | None]:
    """Fillings of ``room`` with at most ``waste`` left, as (index, number) of the distinct ``sizes`` (descending), fullest first; None in place of a dominated one.

    A filling is dominated by one with more in it if an item could be added, or an item
    be replaced by a larger one: whatever packs the rest after the lesser filling also packs
    it after the greater. ``counts`` may change between steps if it is restored before the next.
    """
    first = _first_fit(sizes, room)
    use = [i for i in range(first, len(sizes)) if counts[i]]
    mask = (1 << (room + 1)) - 1
    reach = [1]  # reach[-1 - j]: the sums that the sizes from use[j] on can make
    for i in reversed(use):
        r, n, step = reach[-1], min(counts[i], room // sizes[i]), 1
        while n > 0:
            take = min(step, n)
            r |= r << (take * sizes[i])
            r &= mask
            n, step = n - take, 2 * step
        reach.append(r)
    reach.reverse()

    def options(j: int, rest: int) -> Iterator[tuple[int, int, int]]:
        """(place, number, what is left) of the next item of a filling that sums to ``rest`` from place j on."""
        for at in range(j, len(use)):
            x = sizes[use[at]]
            if x <= rest:
                for k in range(min(counts[use[at]], rest // x), 0, -1):
                    if reach[at + 1] >> (rest - k * x) & 1:
                        yield at, k, rest - k * x
            if not reach[at + 1] >> rest & 1:
                return

    def undominated(chosen: list[tuple[int, int]], left: int) -> bool:
        if not left:
            return True
        taken = dict(chosen)
        if any(sizes[i] <= left and counts[i] > taken.get(i, 0) for i in reversed(use)):
            return False
        for i, _ in chosen:
            for j in range(i - 1, -1, -1):
                if sizes[j] > sizes[i] + left:
                    break
                if counts[j] > taken.get(j, 0):
                    return False
        return True

    sums = reach[0] if use else 1
    for total in range(room, max(room - waste, 0) - 1, -1):
        if not sums >> total & 1:
            continue
        if total == 0:
            yield [] if undominated([], room) else None
            continue
        stack, chosen = [options(0, total)], []
        while stack:
            found = next(stack[-1], None)
            if found is None:
                stack.pop()
                if chosen:
                    chosen.pop()
                continue
            at, k, rest = found
            chosen.append((use[at], k))
            if rest:
                stack.append(options(at + 1, rest))
            else:
                yield list(chosen) if undominated(chosen, room - total) else None
                chosen.pop()


def _first_fit(sizes: list[int], room: int) -> int:
    """The first index of descending ``sizes`` that fits ``room``."""
    lo, hi = 0, len(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        if sizes[mid] > room:
            lo = mid + 1
        else:
            hi = mid
    return lo


@dataclass
class Packing:
    """``bins`` as indices of the sizes; ``nodes``: fillings tried, dominated ones too; ``ended``: bound, exhausted or limit."""

    bins: list[list[int]]
    bound: int
    nodes: int = 0
    ended: str = "bound"


def solve(sizes: list[int], capacity: int, max_nodes: int = PackParams.max_nodes) -> Packing:
    """Pack ``sizes`` (descending, none over ``capacity``)."""
    first = best_fit(sizes, capacity)
    bound, total = lower_bound(sizes, capacity), sum(sizes)
    if len(first) <= bound:
        return Packing(first, bound)
    left = Counter(sizes)
    kinds = sorted(left, reverse=True)
    counts = [left[x] for x in kinds]
    best: list[list[tuple[int, int]]] | None = None
    n_best, nodes, waste, packed = len(first), 0, 0, 0
    done: list[list[tuple[int, int]]] = []
    stack: list[list] = []

    def open_node() -> None:
        head = next(i for i, c in enumerate(counts) if c)
        counts[head] -= 1
        room = capacity - kinds[head]
        stack.append([head, fillings(kinds, counts, room, min(room, (n_best - 1) * capacity - total - waste)), None])

    def rest_by_best_fit() -> list[list[tuple[int, int]]]:
        rest = [i for i, c in enumerate(counts) for _ in range(c)]
        return [sorted(Counter(rest[j] for j in b).items()) for b in best_fit([kinds[i] for i in rest], capacity)]

    open_node()
    while stack and n_best > bound and nodes < max_nodes:
        node = stack[-1]
        head = node[0]
        if node[2] is not None:  # undo
            for i, k in node[2]:
                counts[i] += k
            own = done.pop()
            size = sum(kinds[i] * k for i, k in own)
            waste, packed, node[2] = waste - (capacity - size), packed - sum(k for _, k in own), None
        chosen = next(node[1], ())
        if chosen is None:
            nodes += 1
            continue
        ended = chosen == ()
        size = kinds[head] + sum(kinds[i] * k for i, k in chosen)
        if ended or capacity - size > (n_best - 1) * capacity - total - waste:
            counts[head] += 1
            stack.pop()
            continue
        nodes += 1
        for i, k in chosen:
            counts[i] -= k
        node[2] = chosen
        done.append([(head, 1), *chosen])
        waste, packed = waste + capacity - size, packed + 1 + sum(k for _, k in chosen)
        if packed == len(sizes):
            if len(done) < n_best:
                best, n_best = list(done), len(done)
            continue
        if len(done) % 16 == 0 and len(done) + len(rest := rest_by_best_fit()) < n_best:
            best, n_best = done + rest, len(done) + len(rest)
        open_node()
    ended = "bound" if n_best <= bound else "limit" if nodes >= max_nodes else "exhausted"
    if best is None:
        return Packing(first, bound, nodes, ended)
    spots: dict[int, list[int]] = {}
    for at, x in enumerate(sizes):
        spots.setdefault(x, []).append(at)
    return Packing([[spots[kinds[i]].pop() for i, k in own for _ in range(k)] for own in best], bound, nodes, ended)


def pack(sizes: list[int], capacity: int, max_nodes: int = PackParams.max_nodes) -> list[list[int]]:
    """Bins as indices of ``sizes`` (descending, none over ``capacity``)."""
    return solve(sizes, capacity, max_nodes).bins


def sequences(docs: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """One row for each sequence: the pieces in it as (doc_ids, starts, lengths) in tokens, and the tokens in all."""
    items = stored(docs.select("doc_id", token_count(F.col("text")).alias("n")).where("n > 0"), "pack-items")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, round(total / (p.block_bins * p.capacity)))
    block = F.pmod(F.xxhash64(F.lit(p.seed), F.coalesce("doc_id", F.lit(-1)), "n"), F.lit(blocks)).alias("block")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["block"].iloc[0])
        rows: list[tuple] = []
        rest: list[tuple] = []
        for doc, n in zip(pdf["doc_id"], pdf["n"]):
            doc = None if pd.isna(doc) else int(doc)
            whole, left = divmod(int(n), p.capacity)
            rows += [([doc], [k * p.capacity], [p.capacity], p.capacity) for k in range(whole)]
            if left:
                rest.append((-left, -1 if doc is None else doc, whole * p.capacity, doc))
        rows.sort(key=lambda r: (-1 if r[0][0] is None else r[0][0], r[1]))
        rest.sort(key=lambda r: r[:3])
        for own in pack([-r[0] for r in rest], p.capacity, p.max_nodes):
            some = [rest[i] for i in own]
            rows.append(([r[3] for r in some], [r[2] for r in some], [-r[0] for r in some], -sum(r[0] for r in some)))
        return pd.DataFrame([(f"{b}-{k}", *r) for k, r in enumerate(rows)], columns=["bin_id", "doc_ids", "starts", "lengths", "n_tokens"])

    return items.select("doc_id", "n", block).groupBy("block").applyInPandas(run, SEQUENCES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return sequences(table(spark, sf_dir, "documents"))
