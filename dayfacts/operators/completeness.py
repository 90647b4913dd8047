"""Coverage, availability, attempt logs, gaps and overlaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Failed attempts after which a month is given up.
GIVE_UP_AFTER = 3
DONE = ("success", "unavailable", "given_up")


def month_coverage(df: DataFrame, keys: list[str], day_col: str) -> DataFrame:
    """For each key and month: expected, covered and missing days. Days count once."""
    days = df.select(*keys, F.to_date(day_col).alias("_day")).filter("_day is not null").distinct()
    month = F.trunc("_day", "month").cast("date")
    found = days.groupBy(*keys, month.alias("month_start")).agg(F.count(F.lit(1)).cast("int").alias("covered_days"))
    expected = F.dayofmonth(F.last_day("month_start"))
    return found.withColumn("expected_days", expected).withColumn("missing_days", expected - F.col("covered_days"))


def every_month(coverage: DataFrame, keys: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """``month_coverage`` with a row for every row of ``keys`` and every month from that of
    ``first`` to that of ``last``, so that months without a single day are seen: no covered days,
    all of them missing."""
    months = F.explode(F.expr(f"sequence(trunc(date'{first}', 'MM'), trunc(date'{last}', 'MM'), interval 1 month)")).alias("month_start")
    expected = keys.distinct().select(*keys.columns, months)
    days = F.dayofmonth(F.last_day("month_start"))
    covered = F.coalesce("covered_days", F.lit(0))
    out = expected.join(coverage.drop("expected_days", "missing_days"), [*keys.columns, "month_start"], "left")
    return out.select(*keys.columns, "month_start", covered.alias("covered_days"), days.alias("expected_days"), (days - covered).alias("missing_days"))


def listed_states(state: DataFrame, keys: list[str], status_col: str = "status") -> DataFrame:
    """The states in order of status, then of their keys."""
    return state.orderBy(status_col, *keys)


def coverage_status(covered: Column, expected: Column, reported_no_data: Column) -> Column:
    """success, unavailable (nothing came and the source says that it has nothing), or failed."""
    return F.when(covered == expected, "success").when((covered == 0) & F.coalesce(reported_no_data, F.lit(False)), "unavailable").otherwise("failed")


def fold_attempts(log: DataFrame, keys: list[str], order_col: str, status_col: str) -> DataFrame:
    """The state that a log of attempts leads to: status and attempts of each key.

    An attempt on a key that is done keeps its count; others add one, and a failure that is the
    third is stored as given_up. A ``reset`` entry makes the key failed with no attempts. Entries of
    one time come in order of their status; entries without a time come first.

    A long log is cut where the ranges of a repartition by key and order end. What a piece does
    depends on little: whether the key was done before, and its attempts up to the last before
    giving up. So each piece is folded from each of these states, or from its last reset if it has
    one, and the pieces of a key, no more than there are partitions, are put together in order. No
    key's whole log is gathered.
    """
    cap = GIVE_UP_AFTER - 1

    def done(status: Column) -> Column:
        return F.coalesce(status.isin(*DONE), F.lit(False))

    def state(status: Column, attempts: Column, anew: Column) -> Column:
        return F.struct(status.alias("status"), attempts.alias("attempts"), anew.alias("anew"))

    def step(before: Column, entry: Column) -> Column:
        was_done = done(before["status"])
        attempts = before["attempts"] + F.when(was_done, 0).otherwise(1)
        spent = ~was_done & (entry["status"] == "failed") & (attempts >= GIVE_UP_AFTER)
        return state(F.when(spent, F.lit("given_up")).otherwise(entry["status"]), attempts, before["anew"])

    def join(before: Column, piece: Column) -> Column:
        met = F.least(before["attempts"], F.lit(cap))
        after = F.get(piece["ends"], met * 2 + done(before["status"]).cast("int"))
        attempts = F.when(after["anew"], after["attempts"]).otherwise(before["attempts"] - met + after["attempts"])
        return state(after["status"], attempts, F.lit(False))

    nothing = F.lit(None).cast("string")
    starts = [state(F.lit(DONE[0]) if was_done else nothing, F.lit(n), F.lit(False)) for n in range(cap + 1) for was_done in (False, True)]
    entries = log.select(*keys, F.col(order_col).alias("_at"), F.col(status_col).alias("_status")).repartitionByRange(*keys, "_at", "_status")
    pieces = entries.withColumn("_piece", F.spark_partition_id()).groupBy(*keys, "_piece").agg(F.sort_array(F.collect_list(F.struct(F.col("_at").alias("at"), F.col("_status").alias("status")))).alias("_log"))
    since = F.array_position(F.reverse("_log.status"), "reset")  # entries from the last reset on
    renewed = F.aggregate(F.slice("_log", F.size("_log") - since.cast("int") + 2, since.cast("int") - 1), state(F.lit("failed"), F.lit(0), F.lit(True)), step)
    outcomes = F.when(since > 0, F.array_repeat(renewed, len(starts))).otherwise(F.array(*[F.aggregate("_log", s, step) for s in starts]))
    ends = pieces.select(*keys, F.struct(F.col("_piece").alias("piece"), outcomes.alias("ends")).alias("_ends"))
    whole = F.aggregate(F.array_sort(F.collect_list("_ends"), lambda x, y: x["piece"] - y["piece"]), state(nothing, F.lit(0), F.lit(False)), join)
    return ends.groupBy(*keys).agg(whole.alias("_s")).select(*keys, "_s.status", "_s.attempts")


def pending(state: DataFrame) -> DataFrame:
    return state.filter(~F.coalesce(F.col("status").isin(*DONE), F.lit(False)))


def groups_done(state: DataFrame, keys: list[str]) -> DataFrame:
    """Whether every member of a group is done."""
    return state.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("status").isin(*DONE), F.lit(False))).alias("is_done"))


def status_counts(state: DataFrame, status_col: str = "status") -> DataFrame:
    return state.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


def availability(outcomes: DataFrame, required: list[str], *, key: str = "country_code") -> DataFrame:
    """For each key that was attempted at all, from (key, dataset, status) outcomes: complete,
    partially_available, failed or unavailable over the required datasets, and those of them that
    never succeeded, sorted. A key without any outcome of a required dataset misses them all."""
    wanted = F.coalesce(F.col("dataset").isin(*required), F.lit(False))
    by_key = outcomes.groupBy(key).agg(
        F.collect_set(F.when(wanted & (F.col("status") == "success"), F.col("dataset"))).alias("_won"),
        F.coalesce(F.bool_or(wanted & (F.col("status") == "failed")), F.lit(False)).alias("_lost"),
    )
    names = sorted(set(required))
    won = F.size("_won")
    status = F.when(won == len(names), "complete").when(won > 0, "partially_available").when(F.col("_lost"), "failed").otherwise("unavailable")
    return by_key.select(key, status.alias("availability"), F.array_join(F.array_except(F.array(*map(F.lit, names)), "_won"), ",").alias("missing_datasets"))


def timeline_gaps(df: DataFrame, keys: list[str], slot_col: str, step_seconds: int) -> DataFrame:
    """Missing slots between the first and last slot of each series, as runs: the first missing
    slot and how many. One sort of the series' slots; no spine is built."""
    order = W.partitionBy(*keys).orderBy(slot_col)
    slots = df.select(*keys, slot_col).distinct().withColumn("_before", F.lag(slot_col).over(order))
    apart = (F.unix_timestamp(slot_col) - F.unix_timestamp("_before")) / step_seconds
    return slots.withColumn("_n", apart).filter("_n > 1").select(*keys, F.timestamp_seconds(F.unix_timestamp("_before") + step_seconds).alias("gap_start"), (F.col("_n") - 1).cast("long").alias("missing_slots"))


def overlaps(df: DataFrame, keys: list[str], start_col: str, end_col: str) -> DataFrame:
    """Intervals that begin before an earlier one of their series has ended."""
    earlier = W.partitionBy(*keys).orderBy(start_col, end_col).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_ended", F.max(end_col).over(earlier)).filter(F.col(start_col) < F.col("_ended")).drop("_ended")


def file_prints(listed: DataFrame, batch_col: str = "batch") -> DataFrame:
    """batch, n_files, total and mixed: a fingerprint of each batch's files (path, length) that does
    not depend on their order. Partial sums are combined before they are shuffled; no list is
    gathered. Repeated files count once."""
    h = F.xxhash64("path", "length")
    files = listed.select(batch_col, "path", "length").distinct()
    return files.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_files"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("mixed"))


def batches_to_load(listed: DataFrame, state: DataFrame, batch_col: str = "batch") -> DataFrame:
    """Batches whose files differ from those that were loaded. ``listed`` is batch, path, length,
    ``state`` the same, or what ``file_prints`` gave and was stored."""
    now = file_prints(listed, batch_col)
    then = state if "mixed" in state.columns else file_prints(state, batch_col)
    return now.join(then, now.columns, "left_anti").select(batch_col)
