"""Latest revisions, keyed merges and key comparisons.

Nothing here rewrites a table in place: merges return the new content, and ``sinks`` writes it
beside the old one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_value(df: DataFrame, key: str) -> Column:
    """A key column as merges compare it: of strings, null and the empty string are one value."""
    return F.coalesce(F.col(key), F.lit("")) if df.schema[key].dataType.typeName() == "string" else F.col(key)


def join_keyed(left: DataFrame, right: DataFrame, keys: list[str], how: str, *, null_safe: bool = True) -> DataFrame:
    """A semi or anti join by composite keys. ``null_safe`` also matches null with null, and, of
    strings, null with the empty string; else null matches nothing."""
    value = key_value if null_safe else lambda _, k: F.col(k)
    named = right.select(*[value(right, k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    terms = [value(left, k).eqNullSafe(F.col(f"_key_{i}")) if null_safe else value(left, k) == F.col(f"_key_{i}") for i, k in enumerate(keys)]
    return left.join(named, reduce(lambda a, b: a & b, terms), how)


def latest_per_key(df: DataFrame, keys: list[str], order_col: str, tie_breakers: list[str] | None = None) -> DataFrame:
    """One row for each key: the one with the largest ``order_col``. Ties go to the largest
    remaining columns, in their order, so that the result does not depend on row order."""
    rest = tie_breakers if tie_breakers is not None else [c for c in df.columns if c not in keys and c != order_col]
    latest = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [order_col, *rest]])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def merge_keyed(target: DataFrame, source: DataFrame, keys: list[str], *, null_safe: bool = True) -> DataFrame:
    """Create-or-merge: source rows replace target rows of equal key, new keys are added, nothing
    is deleted. Without ``null_safe`` a null key matches nothing. Keys are unique in the source."""
    kept = join_keyed(target, source, keys, "left_anti", null_safe=null_safe)
    return kept.unionByName(source.select(*target.columns))


def last_write_wins(existing: DataFrame, incoming: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Union where an incoming row beats an existing one of its key whatever their times; among
    rows from one side the latest wins. Null keys match each other."""
    both = existing.withColumn("_side", F.lit(0)).unionByName(incoming.select(*existing.columns).withColumn("_side", F.lit(1)))
    rest = [c for c in existing.columns if c not in keys and c != order_col]
    order = W.partitionBy(*keys).orderBy(F.col("_side").desc(), *[F.col(c).desc_nulls_last() for c in [order_col, *rest]])
    return both.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank", "_side")


def reconcile_window(target: DataFrame, source: DataFrame, column: str, start, end) -> DataFrame:
    """Replace a window of the target (inclusive bounds) by the source's rows for it, so that rows
    which vanished upstream vanish here."""
    inside = F.col(column).between(start, end)
    return target.filter(~F.coalesce(inside, F.lit(False))).unionByName(source.filter(inside).select(*target.columns))


def missing_keys(staged: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows whose key, nulls included, is not among the loaded rows."""
    return join_keyed(staged, loaded, keys, "left_anti")


def missing_by_source(staged: DataFrame, loaded: DataFrame | None, keys: list[str], source_col: str) -> DataFrame:
    """For each source: staged rows, and those whose key was not loaded; all of them where there is
    no loaded table."""
    met = marked_missing(staged, loaded, keys)
    return met.groupBy(source_col).agg(F.count(F.lit(1)).alias("staged_rows"), F.count_if("_missing").alias("missing_rows"))


def marked_missing(staged: DataFrame, loaded: DataFrame | None, keys: list[str]) -> DataFrame:
    """The staged rows with ``_missing``: whether their key, nulls included, was not loaded."""
    if loaded is None:
        return staged.withColumn("_missing", F.lit(True))
    wanted = loaded.select(*[key_value(loaded, k).alias(f"_key_{i}") for i, k in enumerate(keys)]).distinct().withColumn("_found", F.lit(True))
    same = reduce(lambda a, b: a & b, [key_value(staged, k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return staged.join(wanted, same, "left").select(*staged.columns, F.col("_found").isNull().alias("_missing"))


def verify_loaded(staged: DataFrame, loaded: DataFrame | None, keys: list[str], source_col: str, *, sample: int = 5) -> DataFrame:
    """source, status (verified, missing_rows or no_table), staged_rows, missing_rows, and for each
    source with missing rows the first ``sample`` missing keys in their order, a key once.

    The sample is the first few of each source, so that Spark drops the others before it shuffles
    them; the rows of a source are not gathered.
    """
    met = marked_missing(staged, loaded, keys)
    key = F.struct(*keys)
    counts = met.groupBy(source_col).agg(F.count(F.lit(1)).alias("staged_rows"), F.count_if("_missing").alias("missing_rows"))
    first = W.partitionBy(source_col).orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    lost = met.filter("_missing").select(source_col, *keys).distinct().withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= sample)
    shown = lost.groupBy(F.col(source_col).alias("_source")).agg(F.transform(F.sort_array(F.collect_list(F.struct("_rank", key.alias("key")))), lambda x: x["key"]).alias("sample_keys"))
    status = F.lit("no_table") if loaded is None else F.when(F.col("missing_rows") > 0, "missing_rows").otherwise("verified")
    return counts.join(shown, counts[source_col].eqNullSafe(F.col("_source")), "left").select(source_col, status.alias("status"), "staged_rows", "missing_rows", "sample_keys")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique_keys(df: DataFrame, keys: list[str], sample: int = 5, *, null_safe: bool = False) -> DataFrame:
    """The input, if its keys are unique; else an error that shows some duplicates. ``null_safe``
    compares them as null-safe merges do."""
    seen = df.select(*[key_value(df, k).alias(k) for k in keys]) if null_safe else df
    found = duplicate_keys(seen, keys).limit(sample).collect()
    if found:
        raise ValueError(f"duplicate keys: {[r.asDict() for r in found]}")
    return df


def union_with_fallback(primary: DataFrame, alternative: DataFrame, keys: list[str], group: list[str], day_col: str, expected_days: DataFrame, order_col: str) -> DataFrame:
    """The rows of ``resolve_fallback``."""
    return resolve_fallback(primary, alternative, keys, group, day_col, expected_days, order_col)[0]


def resolve_fallback(primary: DataFrame, alternative: DataFrame, keys: list[str], group: list[str], day_col: str, expected_days: DataFrame, order_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows, and one outcome for each group of ``expected_days`` (group, expected).

    A group that covers fewer days under the primary source than expected also gets the
    alternative's rows for keys that the primary lacks; only such groups are looked up there. What
    it then has is covered again: group, status (success, unavailable without a single row, else
    failed), served_by (primary, alternative, both, none), expected, primary_days, days.
    """
    days = F.count_distinct(day_col)
    covered = expected_days.join(primary.groupBy(*group).agg(days.alias("primary_days")), group, "left").fillna(0, ["primary_days"])
    short = covered.filter(F.col("primary_days") < F.col("expected")).select(*group)
    extra = alternative.join(short, group, "left_semi")
    rows = last_write_wins(extra.withColumn("_of", F.lit("alternative")), primary.withColumn("_of", F.lit("primary")), keys, order_col)
    again = rows.join(short, group, "left_semi").groupBy(*group).agg(days.alias("_again"), F.bool_or(F.col("_of") == "alternative").alias("_other"))
    got = F.coalesce("_again", "primary_days")
    status = F.when(got >= F.col("expected"), "success").when(got == 0, "unavailable").otherwise("failed")
    other = F.coalesce("_other", F.lit(False))
    served = F.when(other & (F.col("primary_days") > 0), "both").when(other, "alternative").when(F.col("primary_days") > 0, "primary").otherwise("none")
    outcome = covered.join(again, group, "left").select(*group, status.alias("status"), served.alias("served_by"), "expected", "primary_days", got.alias("days"))
    return rows.drop("_of"), outcome
