"""Links between sets that share a band key: buckets, exact comparison, components.

1. Items that share a band key meet in a bucket. Every one is compared with the bucket's
   smallest, its hub, not with all others: hubs and members are dealt out by hub, large groups
   in parts, and a task reads a hub and then its members in order.
2. Confirmed links give components. Where the items near a hub still belong to several, those
   outside the largest are held against all that can be like them, in blocks of bounded size:
   the differences to the hub are small, and give the exact similarity of any two. Items that
   are not near their hub are held against the others of their bucket in blocks of whole sets.
   A block writes one link for each two components that it joins.

So no link between items of a bucket is lost, and pairs are not written out within a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import at_end, cut, join_sized, local_table, ship
from .components import components
from .shingles import shared

ship(__name__)

#: Similarity to a hub from which an item counts as near it; rows and bytes of either side of a
#: block; members of a hub that are dealt out together.
NEAR, BLOCK, BLOCK_BYTES, PART = 0.45, 1000, 8 << 20, 256
#: A band key is dealt out by item where a sample of one in SAMPLE items shows it so often; at
#: most HOT_KEYS of them.
SAMPLE, HOT_COUNT, HOT_KEYS = 64, 2048, 1 << 14

Reader = Callable[[pa.Array], list[np.ndarray]]
Sets = Callable[[DataFrame], DataFrame]


def parts(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes, and 2048 rows, in a string or binary column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right"))
        end = min(max(end, begin + 1), begin + 2048)
        yield batch.slice(begin, end - begin)
        begin = min(end, batch.num_rows)


def as_sets(items: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in items]


def packed_pairs(banded: DataFrame, spread: int, hot: list[int]) -> DataFrame:
    """part, pairs: the (key, id) of rows of id, bands, dealt to ``spread`` parts by key and packed
    by batch, so that a batch writes a few rows instead of one for each band. Hot keys are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.array(hot, np.int64)
        for batch in batches:
            bands = batch.column(1)
            times = pc.fill_null(pc.list_value_length(bands), 0).to_numpy(zero_copy_only=False)
            two = np.column_stack([bands.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(batch.column(0).to_numpy(zero_copy_only=False), times)])
            if hot:
                two = two[~np.isin(two[:, 0], apart)]
            at = (two[:, 0].view(np.uint64) >> np.uint64(20)) % np.uint64(spread)
            order = np.argsort(at, kind="stable")
            two, at = two[order], at[order]
            begins = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
            pairs = [two[b:e].tobytes() for b, e in zip(begins, np.append(begins[1:], len(at)))]
            yield pa.RecordBatch.from_arrays([pa.array(at[begins].astype(np.int32)), pa.array(pairs, pa.binary())], names=["part", "pairs"])

    return banded.select("id", "bands").mapInArrow(run, "part int, pairs binary")


def part_buckets(packed: DataFrame) -> DataFrame:
    """key, id, hub for rows of ``packed_pairs``: what ``shared_buckets`` gives. A task reads its
    parts in order and holds one."""

    def buckets(held: list[bytes]) -> pa.RecordBatch:
        two = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
        two = two[np.argsort(two[:, 0], kind="stable")]
        new = np.append(True, two[1:, 0] != two[:-1, 0])
        alone = new & np.append(new[1:], True)
        two = two[~alone]
        two = two[np.lexsort((two[:, 1], two[:, 0]))]
        new = np.append(True, two[1:, 0] != two[:-1, 0])[: len(two)]
        hub = two[np.maximum.accumulate(np.where(new, np.arange(len(two)), 0)), 1]
        keep = two[:, 1] != hub
        keep[1:] &= new[1:] | (two[1:, 1] != two[:-1, 1])
        return pa.RecordBatch.from_arrays([pa.array(two[keep, 0]), pa.array(two[keep, 1]), pa.array(hub[keep])], names=["key", "id", "hub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now and held:
                    yield buckets(held)
                    held = []
                now = part
                held.append(pairs)
        if held:
            yield buckets(held)

    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(at_end(run), "key long, id long, hub long")


def shared_buckets(banded: DataFrame) -> DataFrame:
    """key, id, hub for the members of buckets: for the band keys that several ids share, a row
    for every id but the smallest, which is the hub. ``banded`` is a checkpointed table of id,
    bands. Repeated rows change nothing; an id without bands has no bucket.

    Keys are dealt out once, packed, to parts that are twice as many as the shuffle's
    partitions, so that a part stays small as the partitions do. Keys that a sample shows to be
    hot are not dealt out: their hubs, few and combined before they are shuffled, are broadcast
    to the members where they lie. The sample decides the plan only.
    """
    spark = banded.sparkSession
    sample = banded.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(SAMPLE)) == 0).select(F.explode("bands").alias("key"))
    hot = [r["key"] for r in sample.groupBy("key").count().filter(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "key").limit(HOT_KEYS).select("key").collect()]
    cold = part_buckets(packed_pairs(banded, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), hot))
    if not hot:
        return cold
    listed = F.broadcast(local_table(spark, {"key": pa.array(hot, pa.int64())}))
    lying = banded.select(F.explode("bands").alias("key"), "id").join(listed, "key")
    hubs = lying.groupBy("key").agg(F.min("id").alias("hub"))
    met = lying.join(F.broadcast(hubs), "key").filter("id != hub").select("key", "id", "hub").distinct()
    return cold.unionByName(met)


def salted(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hub, id, salt) for the checkpointed pairs (hub, id), and (hub, salt): a hub with many
    members is dealt out in parts of about PART."""
    sizes = cut(pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART))
    salt = F.coalesce(F.pmod(F.xxhash64("id"), F.expr(f"(n + {PART - 1}) div {PART}")).cast("int"), F.lit(0))
    out = cut(join_sized(pairs.select("hub", "id"), sizes, "hub", "left").select("hub", "id", salt.alias("salt")))
    return out, cut(out.select("hub", "salt").distinct())


def beside_hubs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """hub, id, items in the order in which a task reads them: a hub's own items, without an id,
    then those of its members. Every part of a large group has a copy of the hub's items."""
    dealt, heads = salted(pairs)
    members = join_sized(sets, dealt, "id", "inner").select("hub", "salt", "id", "items")
    own = join_sized(sets.withColumnRenamed("id", "hub"), heads, "hub", "inner").select("hub", "salt", F.lit(None).cast("long").alias("id"), "items")
    rows = own.unionByName(members).repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("id").asc_nulls_first())
    return rows.select("hub", "id", "items")


def in_turn(batches: Iterator[pa.RecordBatch], read: Reader) -> Iterator[tuple[pa.RecordBatch, list[int], list[tuple[np.ndarray, np.ndarray]]]]:
    """From rows of ``beside_hubs``: slices, the places of members in them, and (hub's set, member's set)."""
    hub = np.zeros(0, np.uint64)
    for batch in batches:
        for part in parts(batch, 2):
            places, twos = [], []
            for i, (own, found) in enumerate(zip(part.column(1).is_null().to_pylist(), read(part.column(2)))):
                if own:
                    hub = found.copy()
                else:
                    places.append(i)
                    twos.append((hub, found))
            if places:
                yield part, places, twos


def compared(pairs: DataFrame, sets: DataFrame, read: Reader) -> DataFrame:
    """hub, id, n_hub, n, met: sizes of both sets and of what they share, for pairs (hub, id).
    ``sets`` is id, items, one row an id; ``read`` makes sorted sets of hashes of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, places, twos in in_turn(batches, read):
            counts = np.array([(len(x), len(y), shared(x, y)) for x, y in twos], dtype=np.int64).T
            at = part.select([0, 1]).take(pa.array(places))
            yield pa.RecordBatch.from_arrays([*at.columns, *map(pa.array, counts)], names=["hub", "id", "n_hub", "n", "met"])

    return beside_hubs(pairs, sets).mapInArrow(at_end(run), "hub long, id long, n_hub long, n long, met long")


def differences(pairs: DataFrame, sets: DataFrame, read: Reader) -> DataFrame:
    """hub, id, items: the sorted symmetric difference of the hub's set and the item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, places, twos in in_turn(batches, read):
            items = [np.setxor1d(x, y, assume_unique=True).tobytes() for x, y in twos]
            at = part.select([0, 1]).take(pa.array(places))
            yield pa.RecordBatch.from_arrays([*at.columns, pa.array(items, pa.binary())], names=["hub", "id", "items"])

    return beside_hubs(pairs, sets).mapInArrow(at_end(run), "hub long, id long, items binary")


def block_links(x: np.ndarray, whole: np.ndarray, n: np.ndarray, sets: list[np.ndarray], percent: int) -> set[tuple[int, int]]:
    """The components of rows with ``x`` and rows without, other ones, that a block links."""
    xs, ys = np.flatnonzero(x), np.flatnonzero(~x)
    out: set[tuple[int, int]] = set()
    if not len(xs) or not len(ys):
        return out
    d = np.array([len(v) for v in sets], dtype=np.int64)
    element_x, element_y = np.concatenate([sets[i] for i in xs]), np.concatenate([sets[i] for i in ys])
    of_y = np.repeat(np.arange(len(ys)), d[ys])
    order = np.argsort(element_y, kind="stable")
    element_y, of_y = element_y[order], of_y[order]
    begin, end = np.searchsorted(element_y, element_x, "left"), np.searchsorted(element_y, element_x, "right")
    bounds = np.append(0, np.cumsum(d[xs]))
    for k, i in enumerate(xs):
        first, times = begin[bounds[k] : bounds[k + 1]], end[bounds[k] : bounds[k + 1]] - begin[bounds[k] : bounds[k + 1]]
        held = np.flatnonzero(times)
        first, times = first[held], times[held]
        at = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        met = (n[i] + n[ys] - d[i] - d[ys]) // 2 + np.bincount(of_y[at], minlength=len(ys))
        hit = ys[(100 * met >= percent * (n[i] + n[ys] - met)) & (whole[ys] != whole[i])]
        out.update((int(whole[i]), int(c)) for c in np.unique(whole[hit]))
    return out


def links_across(rows: DataFrame, percent: int) -> DataFrame:
    """Exact links between components within blocks: a, b, the components, once for each block
    that links them.

    ``rows`` is block, cx, cy, side (x or y), component, n, items: n the size of an item's set,
    items the sorted 64-bit hashes in which it differs from the block's hub (all of the set, for
    an empty hub). With D the difference, |x & y| = (n_x + n_y - |D_x| - |D_y|) / 2 + |D_x & D_y|. A task reads its blocks in order and holds one at a time. Repeated rows repeat
    links; blocks with one side only, and empty tables, have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[tuple] = []
        links: list[tuple[int, int]] = []

        def close() -> None:
            if held:
                side, whole, n, items = zip(*held)
                links.extend(block_links(np.array(side) == "x", np.array(whole), np.array(n), [np.frombuffer(v, np.uint64) for v in items], percent))
                held.clear()

        for batch in batches:
            for *block, side, whole, n, items in zip(*[c.to_pylist() for c in batch.columns]):
                if block != now:
                    close()
                    now = block
                held.append((side, whole, n, items))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])
            links.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

    dealt = rows.select("block", "cx", "cy", "side", "component", "n", "items").repartition("block", "cx", "cy").sortWithinPartitions("block", "cx", "cy")
    return dealt.mapInArrow(at_end(run), "a long, b long")


def blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of ``links_across`` from block, id, component, n, items, x and y (the sides that
    the row is on), dealt to parts by ``sizes``: block, nx, ny."""
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    x = F.transform(every("ny"), lambda c: F.struct(place("nx", 1).alias("cx"), c.alias("cy"), F.lit("x").alias("side")))
    y = F.transform(every("nx"), lambda c: F.struct(c.alias("cx"), place("ny", 2).alias("cy"), F.lit("y").alias("side")))
    none = F.slice(y, 1, 0)
    at = F.explode(F.concat(F.when(F.col("x"), x).otherwise(none), F.when(F.col("y"), y).otherwise(none))).alias("at")
    return join_sized(rows, sizes, "block", "inner").select("block", at, "component", "n", "items").select("block", "at.*", "component", "n", "items")


def block_sizes(rows: DataFrame, weight: Column) -> DataFrame:
    """block, nx, ny: into how many parts the sides of a block are cut, by rows and bytes."""
    many = lambda side: F.greatest(F.ceil(F.count_if(side) / BLOCK), F.ceil(F.sum(F.when(F.col(side), weight)) / BLOCK_BYTES), F.lit(1)).cast("int")
    return cut(rows.groupBy("block").agg(many("x").alias("nx"), many("y").alias("ny")))


def group_links(near: DataFrame, named: DataFrame, sets: DataFrame, percent: int, read: Reader) -> DataFrame | None:
    """Links within the groups of a hub that hold several components, on differences to the hub:
    what is outside the largest component against all. None if there are no such groups.

    Two sets that reach the threshold differ from the hub by sizes d with |d_x - d_y| <= k *
    (n_x + n_y), k = (100 - percent) / (100 + percent): members of the largest component that are
    further off than that from everything outside it are left out.
    """
    placed = near.select("hub", "id", "n", (F.col("n_hub") + F.col("n") - 2 * F.col("met")).alias("d"))
    placed = join_sized(placed, named, "id", "left").withColumn("component", F.coalesce("component", "id"))
    per = placed.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("size"))
    mains = cut(per.groupBy("hub").agg(F.max(F.struct("size", "component")).alias("most"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("hub", F.col("most.component").alias("main")))
    if mains.isEmpty():
        return None
    k = (100 - percent) / (100 + percent)
    sided = join_sized(placed, mains, "hub", "inner").withColumn("x", F.col("component") != F.col("main")).withColumn("low", F.col("d") - k * F.col("n") - 1e-6).withColumn("high", F.col("d") + k * F.col("n") + 1e-6)
    reach = cut(sided.filter("x").groupBy("hub").agg(F.min("low").alias("lowest"), F.max("high").alias("highest")))
    wanted = cut(join_sized(sided, reach, "hub", "inner").filter("x or (high >= lowest and low <= highest)").select(F.col("hub").alias("block"), "hub", "id", "component", "n", "d", "x", F.lit(True).alias("y")))
    rows = join_sized(differences(wanted, sets, read), wanted, ["hub", "id"], "inner")
    return links_across(blocks(rows, block_sizes(wanted, 8 * F.col("d"))), percent)


def far_links(crowded: DataFrame, near: DataFrame, named: DataFrame, sets: Sets, percent: int, beyond: float, read: Reader) -> DataFrame | None:
    """Links of items that are not near a bucket's hub with other components in the bucket, on
    whole sets. None if there are no such items.

    What is more similar to the hub than ``beyond`` cannot reach the threshold with an item that
    is not near it, as 1 less the similarity is a distance; it is left out.
    """
    met = cut(near.select("hub", "id", (F.col("met") / (F.col("n_hub") + F.col("n") - F.col("met"))).alias("s")))
    others = join_sized(crowded, met, ["hub", "id"], "left").filter(F.col("s").isNull() | (F.col("s") <= beyond))
    placed = cut(others.select(F.col("key").alias("block"), "id", F.col("s").isNull().alias("x")))
    lone = cut(placed.groupBy("block").agg(F.count_if("x").alias("far"), F.count(F.lit(1)).alias("all")).filter("far > 0 and all > 1").select("block"))
    if lone.isEmpty():
        return None
    placed = cut(join_sized(join_sized(placed, lone, "block", "inner"), named, "id", "left").select("block", "id", "x", F.coalesce("component", "id").alias("component"), F.lit(True).alias("y")))
    whole = cut(sets(cut(placed.select("id").distinct())))
    opened = whole.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([p.column(0), pa.array([x.tobytes() for x in read(p.column(1))], pa.binary())], names=["id", "items"]) for b in batches for p in parts(b, 1)), "id long, items binary")
    rows = cut(join_sized(opened, placed, "id", "inner").withColumn("n", F.expr("octet_length(items) div 8")))
    return links_across(blocks(rows, block_sizes(rows, 8 * F.col("n"))), percent)


def linked(crowded: DataFrame, sets: Sets, *, percent: int, read: Reader = as_sets, likely: Callable[[DataFrame], DataFrame] | None = None, slack: float = 0.0) -> DataFrame:
    """node, component over the links between items that share a bucket: 100 * intersection >=
    ``percent`` * union.

    ``crowded`` is what ``shared_buckets`` gives, checkpointed. ``sets(ids)``
    gives id, items, one row an id, for a checkpointed table of ids, from which ``read`` makes
    sorted sets of hashes. ``likely`` may keep those of a table of (hub, id) that are near by an
    estimate that errs by less than ``slack``. No rows: no links.
    """
    stars = crowded.select("hub", "id").distinct()
    stars = cut(likely(stars) if likely else stars)
    items = cut(sets(cut(stars.select(F.explode(F.array("hub", "id")).alias("id")).distinct())))
    near = cut(compared(stars, items, read).filter(F.col("met") >= NEAR * (F.col("n_hub") + F.col("n") - F.col("met")) if likely is None else F.lit(True)))
    alike = near.filter(100 * F.col("met") >= percent * (F.col("n_hub") + F.col("n") - F.col("met")))
    found = cut(components(alike, "hub", "id"))
    named = found.withColumnRenamed("node", "id")
    apart = 1 - percent / 100
    more = [x for x in (group_links(near, named, items, percent, read), far_links(crowded, near, named, sets, percent, NEAR + slack + apart, read)) if x is not None]
    if not more:
        return found
    merged = cut(components(more[0].unionByName(more[1]) if len(more) > 1 else more[0]))
    known = join_sized(found, merged.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return known.unionByName(merged.join(found, "node", "left_anti"))
