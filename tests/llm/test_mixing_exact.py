import random
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from dayfacts.llm import mixing as X


def test_deviation_from_the_exact_weights_does_not_grow(spark):
    """Weights that 1000 parts cannot hold, over 30 periods: no source is ever a whole block
    off."""
    weights = {"a": 0.0001, "b": 0.048496, "c": 0.3004, None: 0.651004}
    rows = {s: round(30_000 * w) + 20 * (s != "a") for s, w in weights.items()}
    begins = {s: sum(list(rows.values())[:i]) for i, s in enumerate(rows)}
    source = F.when(F.col("id") < begins["b"], "a").when(F.col("id") < begins["c"], "b").when(F.col("id") < begins[None], "c")
    docs = spark.range(sum(rows.values())).select(F.col("id").alias("doc_id"), source.alias("source"))
    mixed = X.mix(docs, weights=weights, size_col=None, block_size=1).collect()
    assert sorted(r.mix_slot for r in mixed) == list(range(len(mixed)))
    for s in weights:
        assert [r.mix_rank for r in sorted(mixed, key=lambda r: r.mix_slot) if r.source == s] == list(range(rows[s]))
    seen, exact = Counter(), {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
    for slot, r in enumerate(sorted(mixed, key=lambda r: r.mix_slot), 1):
        seen[r.source] += 1
        if any(seen[s] == rows[s] for s in rows):
            break
        off = [seen[s] - slot * w for s, w in exact.items()]
        assert -1 < min(off) and max(off) < 1
    assert slot > 25_000


def test_random_weights_and_periods():
    """Random weights, periods down to one slot: every block once and in its window."""
    rng = random.Random(3)
    for _ in range(80):
        share = [rng.random() ** rng.choice([1, 3, 8]) + 1e-9 for _ in range(rng.randint(1, 25))]
        weights = [max(1, round(X.PARTS * w / sum(share))) for w in share]
        blocks = [rng.randint(1, 200) for _ in weights]
        fluid = X.Fluid(blocks, weights)
        seen, slot, total, whole = Counter(), 0, sum(weights), True
        for first, end, done, upto in X.periods(fluid, rng.choice([1, 2, 5, 50])):
            assert first == slot and [seen[s] for s in range(len(blocks))] == done.tolist()
            for s, k in zip(*X.period_order(fluid, first, done, upto)):
                assert seen[s] == k
                seen[s] += 1
                slot += 1
                whole = whole and all(seen[i] < n for i, n in enumerate(blocks))
                if whole:
                    assert all(abs(seen[i] * total - slot * w) < total for i, w in enumerate(weights))
                due = fluid.whole(slot)
                assert all(due[i] - 1 < seen[i] < due[i] + 2 for i in range(len(blocks)))
            assert slot == end
        assert [seen[s] for s in range(len(blocks))] == blocks
