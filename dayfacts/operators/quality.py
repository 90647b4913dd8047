"""Data-quality operators. Each returns the rows that fail, unless it says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .revisions import duplicate_keys, join_keyed


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n_failed for every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_failed")) for c in columns])).alias("_c")).select("_c.*")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return duplicate_keys(df, columns)


def accepted_range(df: DataFrame, column: str, low=None, high=None, *, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; null passes."""
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.filter(bad)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a key that the parent lacks; null keys pass."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("_p")), F.col(child_key) == F.col("_p"), "left_anti")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str, tolerance: float = 0.5) -> DataFrame:
    """Keys of both sides whose values differ by more than the tolerance: keys, left_value,
    right_value. A null on either side compares with nothing (``reconcile_nulls`` has those)."""
    a, b = left.select(*keys, F.col(left_value).alias("left_value")), right.select(*keys, F.col(right_value).alias("right_value"))
    return a.join(b, keys).filter(F.abs(F.col("left_value") - F.col("right_value")) > tolerance)


def reconcile_nulls(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str) -> DataFrame:
    a, b = left.select(*keys, F.col(left_value).alias("left_value")), right.select(*keys, F.col(right_value).alias("right_value"))
    return a.join(b, keys).filter("left_value is null or right_value is null")


def shares_off_total(df: DataFrame, keys: list[str], share_col: str, total: float = 100.0, tolerance: float = 0.5) -> DataFrame:
    """Groups whose known shares do not add up."""
    return df.groupBy(*keys).agg(F.sum(share_col).alias("share_total")).filter(F.abs(F.col("share_total") - total) > tolerance)


def judged(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """The rows with ``failed_rules``, the rules that they fail, as (rule, reason). ``rules`` maps a name
    to the condition that a good row meets (null: not met) and the reason for its rejection."""
    checks = [F.when(~F.coalesce(good, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(reason).alias("reason"))) for name, (good, reason) in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*checks)))


def rejections(marked: DataFrame, *, source_system: Column, country: Column, dataset: Column, processing_date: Column, record_id: Column, ingested_at: Column) -> DataFrame:
    """A row for each rule that a row of ``judged`` fails, with what is needed to find it again."""
    found = {"source_system": source_system, "country": country, "dataset": dataset, "processing_date": processing_date, "record_id": record_id, "ingested_at": ingested_at}
    return marked.select(*[c.alias(n) for n, c in found.items()], F.explode("failed_rules").alias("_f")).select(*found, "_f.rule", "_f.reason")


def quarantine(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first rule that fails and its reason). For every rule that
    fails see ``rejections``, to write both sides in one pass ``sinks.write_by_outcome``."""
    marked = judged(df, rules)
    first = F.get("failed_rules", F.lit(0))
    return marked.filter("size(failed_rules) = 0").drop("failed_rules"), marked.filter("size(failed_rules) > 0").select(*df.columns, first["rule"].alias("rule"), first["reason"].alias("reason"))


def unknown_units(df: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose (keys, unit) is not on the allow list; nulls are not on any list."""
    return join_keyed(df, allowed, keys, "left_anti", null_safe=False)


def implausible(df: DataFrame, bounds: DataFrame, variable_col: str, value_col: str) -> DataFrame:
    """Rows beyond the bounds of their variable, with the bound's action. ``bounds`` is variable,
    low, high, action; a missing bound is none."""
    b = bounds.select(F.col("variable").alias("_v"), "low", "high", "action")
    beyond = (F.col(value_col) < F.col("low")) | (F.col(value_col) > F.col("high"))
    return df.join(b, F.col(variable_col) == F.col("_v")).filter(beyond).drop("_v", "low", "high")


def run_metrics(df: DataFrame, keys: list[str], required: list[str], status_col: str | None = None) -> DataFrame:
    """One row: rows received, rows that repeat a key, rows with a required null, and partial rows."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    part = F.col(status_col) == "partial" if status_col else F.lit(False)
    by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_nulls"), F.count_if(part).alias("_partial"))
    return by_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_received"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"), F.coalesce(F.sum("_nulls"), F.lit(0)).alias("rows_with_nulls"), F.coalesce(F.sum("_partial"), F.lit(0)).alias("partial_rows"))


def freshness(df: DataFrame, date_col: str, status_col: str) -> DataFrame:
    """One row: the latest date with data, the latest complete one, and the days between them."""
    latest = F.max(date_col).alias("latest_date")
    whole = F.max(F.when(F.col(status_col) == "complete", F.col(date_col))).alias("latest_complete_date")
    return df.agg(latest, whole).withColumn("days_behind", F.datediff("latest_date", "latest_complete_date"))


#: What a watermark can tell of: a run of a workflow, an arrival, data of a date, a date complete
#: enough for analysis, and a publication.
EVENTS = ("executed", "ingested", "data", "complete", "published")


def watermarks(df: DataFrame, source: Column, layer: str, run: int, **events: Column) -> DataFrame:
    """source, layer, run, event, at: the latest time of each event of a source in a layer's table,
    in one aggregate. An event without a time has no row."""
    unknown = sorted(set(events) - set(EVENTS))
    if unknown:
        raise ValueError(f"not among {EVENTS}: {unknown}")
    latest = df.groupBy(source.alias("source")).agg(*[F.max(at.cast("timestamp")).alias(e) for e, at in events.items()])
    each = F.explode(F.array(*[F.struct(F.lit(e).alias("event"), F.col(e).alias("at")) for e in events]))
    return latest.select("source", F.lit(layer).alias("layer"), F.lit(run).cast("long").alias("run"), each.alias("_e")).select("source", "layer", "run", "_e.event", "_e.at").filter("at is not null")


def freshness_of_layers(marks: DataFrame, run: int, by: list[str]) -> DataFrame:
    """The table of all ``watermarks`` folded in one aggregate, as of a run: ``by`` (source, layer or
    both); the latest time of each event (executed_at and so on); usable_before, the latest
    usable date of earlier runs; days_behind, from the usable date to the execution; status.

    A group's usable date is its latest complete one, or that of its data where no layer of it
    tells of complete ones. Status: not_executed (no execution in this run), empty (no usable date),
    stale (executed, and the usable date is not later than before), advanced. Null source: a
    source of its own. Later runs do not count.
    """
    at, now = F.col("at"), F.col("run") == run
    upto = [F.max(F.when(F.col("event") == e, at)).alias(f"{e}_at") for e in EVENTS]
    before = {e: F.max(F.when(~now & (F.col("event") == e), at)) for e in ("data", "complete")}
    executed = F.count_if(now & (F.col("event") == "executed")) > 0
    folded = marks.filter(F.col("run") <= run).groupBy(*by).agg(*upto, before["data"].alias("_data"), before["complete"].alias("_complete"), executed.alias("_executed"))
    tells = F.col("complete_at").isNotNull()
    usable = F.coalesce("complete_at", "data_at")
    out = folded.withColumn("usable_before", F.when(tells, F.col("_complete")).otherwise(F.col("_data")))
    status = F.when(~F.col("_executed"), "not_executed").when(usable.isNull(), "empty").when(usable <= F.col("usable_before"), "stale").otherwise("advanced")
    return out.withColumn("days_behind", F.datediff("executed_at", usable)).withColumn("status", status).drop("_data", "_complete", "_executed")


def table_checks(df: DataFrame, keys: list[str], parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """check_name, n_failed for a published table: has rows, null keys, unique grain, no orphans."""
    rows = df.agg((F.count(F.lit(1)) == 0).cast("long").alias("n_failed")).select(F.lit("has_rows").alias("check_name"), "n_failed")
    nulls = not_null(df, keys).agg(F.count(F.lit(1)).alias("n_failed")).select(F.lit("keys_not_null").alias("check_name"), "n_failed")
    grain = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n_failed")).select(F.lit("grain_unique").alias("check_name"), "n_failed")
    out = rows.unionByName(nulls).unionByName(grain)
    for column, (parent, key) in parents.items():
        lost = orphans(df, parent, column, key).agg(F.count(F.lit(1)).alias("n_failed"))
        out = out.unionByName(lost.select(F.lit(f"orphans_{column}").alias("check_name"), "n_failed"))
    return out
