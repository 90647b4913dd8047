"""Mixing sources to target weights by Pfair scheduling.

Every source's documents form a stream cut into blocks of equal size. In the fluid schedule that
is aimed at, all sources that have blocks left are served at once, in proportion to their weights.
A block is released in the slot in which that schedule begins it and due when it ends it; the
earliest deadline first fills each slot. No source is then ever a whole block away from its share,
at any slot, before or after others have run out.

The slots are cut into periods: the driver finds which blocks each period takes, from the exact
windows, and the executors order the blocks of each period. One form serves every size and every
number of sources.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cmp_to_key
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, join_sized, local_table, ship

ship(__name__)

#: Parts of exact weights: over 2^29 blocks, rounding to them moves a target by less than 2^-11 of a block.
PARTS = 1 << 40
#: Sources times periods: what the driver looks at one by one. Periods grow where sources are many.
STEPS = 1 << 23


def divided(a: np.ndarray, b: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder of a * b by ``by``, exact for products beyond 64 bits with quotients
    below 2^50: doubles miss the quotient by at most one, and the remainder, which is small, is
    right in arithmetic that wraps around."""
    q = np.floor(a.astype(float) * b / by).astype(np.int64)
    rest = a * b - q * by
    step = (rest >= by).astype(np.int64) - (rest < 0)
    return q + step, rest - step * by


class Fluid:
    """The schedule in which source s, of weight a_s and n_s blocks, is served at the rate a_s by
    the sum of the weights of those that have blocks left.

    With v for the service a unit of weight has got, slot(v) = sum of min(n_s, a_s * v): linear
    between the points n_s / a_s at which sources run out.
    """

    def __init__(self, blocks: np.ndarray, weights: np.ndarray):
        self.blocks, self.weights = np.asarray(blocks, np.int64), np.asarray(weights, np.int64)
        n, a = self.blocks.tolist(), self.weights.tolist()
        last = sorted(range(len(n)), key=cmp_to_key(lambda i, j: n[i] * a[j] - n[j] * a[i]))
        self.last = [(n[i], a[i]) for i in last]
        self.points = self.blocks[last] / self.weights[last]
        self.gone = np.concatenate([[0], self.blocks[last].cumsum()])
        self.active = self.weights.sum() - np.concatenate([[0], self.weights[last].cumsum()])
        self.rank = np.empty(len(n), np.int64)
        self.rank[last] = np.arange(len(n))
        self.ends = self.windows(np.array(last, np.int64), self.blocks[last])[1]

    def windows(self, source: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot, rounded down and up, at which the source has got so many whole blocks."""
        a = self.weights[source]
        v = block / a
        piece = np.searchsorted(self.points, v * (1 - 1e-12))
        upto = np.searchsorted(self.points, v * (1 + 1e-12), "right")
        for j in np.flatnonzero(piece != upto):  # doubles do not tell: whole numbers do
            lo, hi, k, w = int(piece[j]), int(upto[j]), int(block[j]), int(a[j])
            while lo < hi:
                mid = (lo + hi) // 2
                if self.last[mid][0] * w <= k * self.last[mid][1]:
                    lo = mid + 1
                else:
                    hi = mid
            piece[j] = lo
        q, rest = divided(block, self.active[piece], a)
        down = self.gone[piece] + q
        return down, down + (rest > 0)

    def whole(self, slot: int) -> np.ndarray:
        """How many whole blocks each source has got at a slot."""
        piece = int(np.searchsorted(self.ends, slot, "right"))
        if piece == len(self.last):
            return self.blocks.copy()
        got, _ = divided(self.weights, np.int64(slot - self.gone[piece]), self.active[piece])
        return np.where(self.rank < piece, self.blocks, got)


def run_of(done: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Source and number of every block from those in ``done`` up to those in ``upto``."""
    size = upto - done
    source = np.repeat(np.arange(len(done)), size)
    return source, np.arange(len(source)) - np.repeat(size.cumsum() - size, size) + done[source]


def taken_by(fluid: Fluid, first: int, end: int, done: np.ndarray) -> np.ndarray:
    """How many blocks of each source are placed before slot ``end``, given those placed before
    slot ``first``, so that every block of the period and of all later ones has a slot within its
    window.

    All blocks due by ``end`` are taken. The rest of the slots goes to released blocks, the first
    due first, each only if the blocks released at or after any slot t of the period stay no more
    than the slots from t to ``end``. These sets of late blocks are nested, so taking greedily
    leaves, for every later slot, the fewest blocks that are due by then.
    """
    out = np.maximum(done, fluid.whole(end))
    rest = end - int(out.sum())
    if rest == 0:
        return out
    length = end - first
    at, _ = fluid.windows(*run_of(done, out))
    late = np.bincount(np.maximum(at - first, 0), minlength=length)  # by slot of the period: blocks taken that are released there
    free = np.minimum.accumulate(np.arange(length, 0, -1) - late[::-1].cumsum()[::-1])
    more = np.flatnonzero(out < fluid.blocks)
    start, due = fluid.windows(more, out[more])[0], fluid.windows(more, out[more] + 1)[1]
    begun = start < end
    more, start, due = more[begun], np.maximum(start[begun] - first, 0), due[begun]
    slots, index = np.unique(start, return_inverse=True)
    left = (free[slots] - np.append(free[slots][1:], 0)).tolist()
    to = [j if n else j + 1 for j, n in enumerate(left)] + [len(left)]  # the nearest later place with room, or the end

    def room(j: int) -> int:
        while to[j] != j:
            to[j] = to[to[j]]
            j = to[j]
        return j

    for x in np.lexsort((more, due)).tolist():
        if rest == 0:
            break
        j = room(int(index[x]))
        if j < len(left):
            out[more[x]] += 1
            rest -= 1
            left[j] -= 1
            if left[j] == 0:
                to[j] = j + 1
    if rest:
        raise AssertionError("a period does not hold what is due")
    return out


def period_order(fluid: Fluid, first: int, done: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Source and block of each slot from ``first``: of the period's blocks that are released the
    first due, ties to the smallest source, where all are due by the period's end."""
    source, block = run_of(done, upto)
    due = np.minimum(fluid.windows(source, block + 1)[1], first + len(source)).tolist()
    start = np.maximum(fluid.windows(source, block)[0] - first, 0)
    waiting = np.argsort(start, kind="stable").tolist()
    until = start[waiting].searchsorted(np.arange(len(source)), "right").tolist()
    ready: list[tuple[int, int]] = []  # run_of counts by source, so its numbers break ties
    order, at = [], 0
    for slot, n in enumerate(until, first):
        for x in waiting[at:n]:
            heapq.heappush(ready, (due[x], x))
        at = n
        end, x = heapq.heappop(ready)
        if end <= slot:
            raise AssertionError("a block missed its deadline")
        order.append(x)
    return source[order], block[order]


def periods(fluid: Fluid, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first slot, end, blocks placed before, blocks placed by the end) for periods of at most
    ``length`` slots."""
    total, first, done = int(fluid.blocks.sum()), 0, np.zeros_like(fluid.blocks)
    while first < total:
        end = min(total, first + length)
        upto = taken_by(fluid, first, end, done)
        yield first, end, done, upto
        first, done = end, upto


def planned(fluid: Fluid, length: int) -> pa.Table:
    """A row for each period: first, end and, for either, the sources that are a block ahead of
    the whole blocks that are due by then, as 32-bit numbers."""
    rows = []
    for first, end, done, upto in periods(fluid, length):
        ahead = [np.flatnonzero(n > fluid.whole(at)).astype(np.int32).tobytes() for at, n in ((first, done), (end, upto))]
        rows.append((first, end, *ahead))
    kinds = {"first": pa.int64(), "end": pa.int64(), "ahead": pa.binary(), "ahead_by_end": pa.binary()}
    return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 4, kinds.values())], names=list(kinds))


def ordered(plan: DataFrame, fluid: Fluid) -> DataFrame:
    """_place (the source's number), _block, _slot of every block of the planned periods."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                done, upto = fluid.whole(r["first"]), fluid.whole(r["end"])
                done[np.frombuffer(r["ahead"], np.int32)] += 1
                upto[np.frombuffer(r["ahead_by_end"], np.int32)] += 1
                source, block = period_order(fluid, r["first"], done, upto)
                yield pa.RecordBatch.from_arrays([pa.array(source), pa.array(block), pa.array(np.arange(r["first"], r["end"]))], names=["_place", "_block", "_slot"])

    return plan.mapInArrow(run, "_place long, _block long, _slot long")


def mix(docs: DataFrame, *, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source", size_col: str | None = "n_chars", block_size: int = 65_536, period: int = 1000, power: float = 0.5, group_rows: int = 2000) -> DataFrame:
    """All rows and columns of ``docs``, with mix_block, mix_slot and mix_rank added: the block of
    the document in its source, that block's place in the mixture, and the document's place in
    its source. Sort by (mix_slot, mix_rank) for the mixture.

    ``weights`` gives target shares by source, for every source, else KeyError; by default a
    source's share follows its total size to the given power. At every slot, whatever the number
    of sources, each is less than a block off its share of the slots so far; when a source has run
    out, its share goes to the others in proportion to their weights. Sizes come from
    ``size_col`` (null or less than 1: 1; no column: 1 each), and are not checked against texts; a
    document belongs to the block in which it starts. Blocks within a source hold documents in an
    order drawn by hash, so that a hot source is dealt over many groups.

    The driver holds one row per source and, for each period, the sources that are a block ahead.
    Periods have ``period`` slots, or the square root of all slots, or as many as keep sources
    times periods within STEPS. Null source: a source of its own. Null ids sort first; equal ids are
    ordered by size and the hash of the row; repeated rows: a place each. Empty table: no rows.
    Columns of the input with the names of the added ones are replaced; all others are carried
    along, whatever their names.
    """
    added = ["mix_block", "mix_slot", "mix_rank"]
    docs = docs.drop(*added)
    size = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(1)), F.lit(1)) if size_col else F.lit(1)
    hashed = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind]
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_from"), size.cast("long").alias("_size"), F.xxhash64(*hashed).alias("_tie"))
    found = sized.groupBy(F.col("_from").alias("source")).agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    found.sort(key=lambda r: (r["source"] is not None, r["source"] or ""))
    lost = [r["source"] for r in found if weights and r["source"] not in weights]
    if lost:
        raise KeyError(f"no weight for {len(lost)} sources, as {lost[:5]}")
    share = [float(weights[r["source"]] if weights else r["size"] ** power) for r in found]
    fluid = Fluid([-(-r["size"] // block_size) for r in found], [max(1, round(PARTS * w / sum(share))) for w in share])
    slots_in_all = int(fluid.blocks.sum())
    length = max(period, isqrt(slots_in_all), slots_in_all * len(found) // STEPS)
    spark = docs.sparkSession

    salts = min(1 << 16, max(1, -(-sum(r["rows"] for r in found) // group_rows)))
    key = F.coalesce(F.concat(F.lit("="), "_from"), F.lit(""))
    salted = sized.withColumn("_key", key).withColumn("_salt", F.pmod(F.xxhash64("_id", F.when(F.col("_id").isNull(), F.monotonically_increasing_id())), F.lit(salts)).cast("int"))
    groups = salted.groupBy("_key", "_salt").agg(F.sum("_size").alias("_group_size"), F.count(F.lit(1)).alias("_group_rows"))
    earlier = W.partitionBy("_key").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = groups.select("_key", "_salt", F.coalesce(F.sum("_group_size").over(earlier), F.lit(0)).alias("_size_before"), F.coalesce(F.sum("_group_rows").over(earlier), F.lit(0)).alias("_rows_before"))

    within = W.partitionBy("_key", "_salt").orderBy("_id", "_size", "_tie")
    ranked = salted.withColumn("_n", F.row_number().over(within)).withColumn("_before", F.sum("_size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("_size"))
    placed = ranked.join(offsets, ["_key", "_salt"])
    placed = placed.withColumn("mix_block", F.expr(f"(_size_before + _before) div {int(block_size)}")).withColumn("mix_rank", F.col("_rows_before") + F.col("_n") - 1)
    names = local_table(spark, {"_place": pa.array(range(len(found)), pa.int64()), "_source": pa.array([r["source"] for r in found], pa.string())})
    turns = ordered(spark.createDataFrame(planned(fluid, length)), fluid)
    slots = cut(join_sized(turns, names, "_place", "inner").select("_source", "_block", "_slot"))
    on = F.col("_from").eqNullSafe(F.col("_source")) & (F.col("mix_block") == F.col("_block"))
    return join_sized(placed, slots, on, "inner").withColumn("mix_slot", F.col("_slot")).select("_row.*", *added)
