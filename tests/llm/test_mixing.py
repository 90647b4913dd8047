import random
from bisect import bisect_right as bisect
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayfacts.llm import mixing as X


def fluid_of(blocks, weights):
    return X.Fluid(list(blocks.values()), list(weights.values()))


def placed_by(fluid, length):
    """(source, block) of every slot, from periods of so many slots."""
    out = []
    for first, end, done, upto in X.periods(fluid, length):
        out += zip(*map(list, map(lambda x: x.tolist(), X.period_order(fluid, first, done, upto))))
        assert len(out) == end
    return out


def served(blocks, weights):
    """Each source's exact share of the first t slots, for t = 1, 2, ...: rates change within a
    slot where a source runs out."""
    got = {s: Fraction(0) for s in blocks}
    for _ in range(sum(blocks.values())):
        room = Fraction(1)
        while room:
            active = [s for s in blocks if got[s] < blocks[s]]
            total = sum(weights[s] for s in active)
            step = min([room / total] + [(blocks[s] - got[s]) / weights[s] for s in active])
            for s in active:
                got[s] += step * weights[s]
            room -= step * total
        yield dict(got)


def simulate(blocks, weights):
    """Earliest deadline first, slot by slot, from the exact shares: a block is released in the
    slot in which its share begins, and due when it is whole."""
    shares = [dict.fromkeys(blocks, Fraction(0)), *served(blocks, weights)]
    first = {(s, k): min(t - 1 for t, got in enumerate(shares) if got[s] > k) for s, n in blocks.items() for k in range(n)}
    due = {(s, k): min(t for t, got in enumerate(shares) if got[s] >= k + 1) for s, n in blocks.items() for k in range(n)}
    order, left = [], set(first)
    for slot in range(len(first)):
        x = min((x for x in left if first[x] <= slot), key=lambda x: (due[x], x))
        assert due[x] > slot
        left.remove(x)
        order.append(x)
    return order


CASES = [({0: 10, 1: 3, 2: 40}, {0: 3, 1: 2, 2: 1}), ({0: 0, 1: 5}, {0: 9, 1: 1}), ({0: 1}, {0: 5}), ({}, {}), ({0: 200, 1: 7, 2: 90, 3: 1}, {0: 5, 1: 3, 2: 8, 3: 1}), ({i: 3 for i in range(12)}, {i: 7 for i in range(12)}), ({i: 1 + i * i for i in range(9)}, {i: 1 + i for i in range(9)})]


@pytest.mark.parametrize("blocks, weights", CASES)
def test_blocks_follow_the_schedule(blocks, weights):
    assert placed_by(fluid_of(blocks, weights), 1000) == simulate(blocks, weights)


@pytest.mark.parametrize("blocks, weights", CASES)
def test_windows_are_those_of_the_exact_shares(blocks, weights):
    fluid = fluid_of(blocks, weights)
    for slot, got in enumerate(served(blocks, weights), 1):
        assert fluid.whole(slot).tolist() == [int(x) for x in got.values()]


@pytest.mark.parametrize("length", [1, 3, 17, 1000])
@pytest.mark.parametrize("blocks, weights", CASES)
def test_no_source_is_a_whole_block_off_to_the_end(blocks, weights, length):
    seen, order = Counter(), placed_by(fluid_of(blocks, weights), length)
    assert sorted(order) == [(s, k) for s, n in sorted(blocks.items()) for k in range(n)]
    for (s, k), got in zip(order, served(blocks, weights), strict=True):
        assert seen[s] == k
        seen[s] += 1
        assert all(abs(seen[x] - share) < 1 for x, share in got.items())


def test_ten_thousand_sources_stay_within_a_block():
    """Every source at every slot: no block begins before its share does or ends after it, by
    windows in whole numbers of any size."""
    n = 10_000
    blocks = [1 + (i * 7919) % 13 + (3000 if i % 2500 == 0 else 0) for i in range(n)]
    weights = [max(1, round(X.PARTS * b**0.5 / 37_000)) for b in blocks]
    fluid = X.Fluid(blocks, weights)
    done_by = sorted(range(n), key=lambda i: Fraction(blocks[i], weights[i]))
    points, gone, active = [Fraction(blocks[i], weights[i]) for i in done_by], [0], [sum(weights)]
    for i in done_by:
        gone.append(gone[-1] + blocks[i])
        active.append(active[-1] - weights[i])
    order = placed_by(fluid, 5000)
    assert Counter(s for s, _ in order) == dict(enumerate(blocks))
    for slot, (s, k) in enumerate(order):
        v, w = Fraction(k, weights[s]), Fraction(k + 1, weights[s])
        i, j = bisect(points, v), bisect(points, w)
        assert gone[i] + v * active[i] < slot + 1 and gone[j] + w * active[j] > slot


def test_products_beyond_64_bits():
    rng = random.Random(5)
    rows = [(rng.getrandbits(rng.randint(1, 31)), rng.getrandbits(rng.randint(1, 41)), rng.getrandbits(rng.randint(8, 40)) + 1) for _ in range(20_000)]
    rows = [r for r in rows if r[0] * r[1] // r[2] < 1 << 50] + [(x * y, z, x) for x, y, z in rows[:500] if x and x * y < 1 << 31 and y * z < 1 << 50]
    q, rest = X.divided(*(np.array(c, np.int64) for c in zip(*rows)))
    assert list(zip(q.tolist(), rest.tolist())) == [divmod(a * b, c) for a, b, c in rows]


def test_exact_weights_over_many_slots():
    """A third, two thirds and a hundred-thousandth, over a hundred thousand slots."""
    weights = {0: X.PARTS // 3, 1: X.PARTS * 2 // 3, 2: X.PARTS // 100_000}
    total, seen = sum(weights.values()), Counter()
    for slot, (s, _) in enumerate(placed_by(fluid_of({0: 33_300, 1: 66_600, 2: 2}, weights), 400), 1):
        seen[s] += 1
        if any(seen[k] == n for k, n in ((0, 33_300), (1, 66_600), (2, 2))):
            break
        assert all(abs(seen[k] * total - slot * w) < total for k, w in weights.items())
    assert slot > 90_000


def test_documents_follow_their_blocks(small):
    docs = small["documents"]
    out = X.mix(docs, block_size=5000, group_rows=20)
    assert out.columns == [*docs.columns, "mix_block", "mix_slot", "mix_rank"]
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    sizes, streams = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.source] += max(r.n_chars, 1)
        streams[r.source].append(r)
    names = sorted(sizes)
    share = {i: sizes[s] ** 0.5 for i, s in enumerate(names)}
    weights = {i: round(X.PARTS * w / sum(share.values())) for i, w in share.items()}
    order = simulate({i: -(-sizes[s] // 5000) for i, s in enumerate(names)}, weights)
    place = {k: i for i, k in enumerate(order)}
    for i, s in enumerate(names):
        at = 0
        for k, r in enumerate(sorted(streams[s], key=lambda r: r.mix_rank)):
            assert (r.mix_rank, r.mix_block, r.mix_slot) == (k, at // 5000, place[i, at // 5000])
            at += max(r.n_chars, 1)


def test_awkward_documents(spark, awkward):
    rows = X.mix(awkward, block_size=10, group_rows=2).collect()
    assert len(rows) == awkward.count() and {r.source for r in rows} == {"a", "b", "c", None}
    assert all(isinstance(r.mix_slot, int) for r in rows)
    assert len({(r.source, r.mix_rank) for r in rows}) == len(rows)
    assert X.mix(awkward.limit(0)).count() == 0
    given = X.mix(awkward, weights={"a": 2, "b": 1, "c": 1, None: 1}, size_col=None, block_size=1).collect()
    assert sorted(r.mix_slot for r in given) == list(range(len(given)))


def test_a_hot_source_is_dealt_over_groups(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"))
    rows = X.mix(docs, size_col=None, block_size=10, group_rows=10).collect()
    assert sorted(r.mix_rank for r in rows) == list(range(1000)) and Counter(r.mix_slot for r in rows) == {b: 10 for b in range(100)}


@pytest.mark.parametrize("given", [False, True])
def test_many_sources(spark, given):
    """3000 sources: every block has a slot of its own, in order, and no source is a whole block
    off its share until one runs out."""
    n = {i: 200 if i < 4 else 3 + i % 5 for i in range(3000)}
    docs = spark.createDataFrame([(1000 * i + k, f"s{i}" if i else None) for i in n for k in range(n[i])], "doc_id long, source string")
    weights = {(f"s{i}" if i else None): n[i] for i in n}
    rows = X.mix(docs, weights=weights if given else None, power=1.0, size_col=None, block_size=1).collect()
    rows.sort(key=lambda r: r.mix_slot)
    assert [r.mix_slot for r in rows] == list(range(sum(n.values())))
    seen, total = Counter(), len(rows)
    for slot, r in enumerate(rows, 1):
        assert r.mix_block == seen[r.source]
        seen[r.source] += 1
        assert abs(seen[r.source] - slot * weights[r.source] / total) < 1 + 2**-11  # weights are rounded to 2^-40
        if slot % 500 == 0:
            assert all(abs(seen[s] - slot * w / total) < 1 + 2**-11 for s, w in weights.items())
