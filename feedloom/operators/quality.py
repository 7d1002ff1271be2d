"""Data-quality suites: one aggregation per table, one output row per check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedloom.schema import LABEL_SET_ROWS, SCORE_RANGE

@dataclass(frozen=True)
class RowCount:
    """The table has between ``low`` and ``high`` rows."""

    low: int
    high: int


@dataclass(frozen=True)
class Between:
    """Non-null values lie in a closed range."""

    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; every member of a duplicate group is unexpected."""

    column: str


@dataclass(frozen=True)
class HasColumn:
    column: str


Check = RowCount | Between | Unique | HasColumn


class CheckFailed(ValueError):
    pass


SCORES_SUITE: tuple[Check, ...] = (Between("predicted", *SCORE_RANGE), Unique("id"), HasColumn("id"), HasColumn("predicted"))
LABEL_SET_SUITE: tuple[Check, ...] = (RowCount(*LABEL_SET_ROWS),)


def _result(check: str, column: str, unexpected: Column) -> Column:
    bad = unexpected.cast("bigint")
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        (bad == 0).alias("success"),
        bad.alias("unexpected"),
    )


def run_checks(df: DataFrame, *checks: Check) -> DataFrame:
    """``check, column, success, unexpected`` for every check, from one pass.

    A uniqueness check groups by its column first; counts and range violations ride
    along on that grouping, so the table is read once. A check of a column that is not
    there fails: every row is unexpected, and at least one is reported.
    """
    there = lambda c: c.column in df.columns
    unique = [c for c in checks if isinstance(c, Unique) and there(c)]
    if len(unique) > 1:
        raise ValueError("one uniqueness check per pass")
    ranges = [c for c in checks if isinstance(c, Between) and there(c)]
    missing = F.greatest(F.col("_rows"), F.lit(1))
    measures = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(~F.col(c.column).between(c.low, c.high)).alias(f"_out{i}") for i, c in enumerate(ranges)
    ]
    if unique:
        key = unique[0].column
        per_key = df.groupBy(key).agg(*measures)
        repeated = F.when((F.col("_rows") > 1) & F.col(key).isNotNull(), F.col("_rows")).otherwise(0)
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_key.columns if c.startswith("_")]
        totals = per_key.agg(F.coalesce(F.sum(repeated), F.lit(0)).alias("_repeated"), *sums)
    else:
        totals = df.agg(*measures)
    rows = []
    for check in checks:
        match check:
            case RowCount(low, high):
                outside = F.when(F.col("_rows").between(low, high), 0).otherwise(1)
                rows.append(_result("row_count_between", "*", outside))
            case Between(column):
                rows.append(_result("values_between", column, F.col(f"_out{ranges.index(check)}") if there(check) else missing))
            case Unique(column):
                rows.append(_result("values_unique", column, F.col("_repeated") if there(check) else missing))
            case HasColumn(column):
                rows.append(_result("column_exists", column, F.lit(0 if column in df.columns else 1)))
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(results: DataFrame) -> None:
    """Stop a job whose table fails a check. There is one row per check."""
    failed = results.where(~F.col("success")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}({r['column']}): {r['unexpected']} unexpected" for r in failed))


def measured(df: DataFrame, checks: tuple[Check, ...], within: tuple[str, ...] = ()) -> tuple[DataFrame, Observation | None]:
    """``df`` with metrics for the suite that the next action on it fills, so the checks need no read of their own.

    For a uniqueness check rows of one key must meet: they are brought together by that key, or, where ``within`` names columns
    that the key decides and the rows are already together by, without a shuffle. Other checks cost nothing but the counting. A
    column that is not there fails before anything runs.
    """
    if not checks:
        return df, None
    there = lambda c: c.column in df.columns
    absent = [c.column for c in checks if not isinstance(c, RowCount) and not there(c)]
    if absent:
        raise CheckFailed("; ".join(f"column_exists({c}): not there" for c in dict.fromkeys(absent)))
    metrics, columns = [F.count(F.lit(1)).alias("rows")], df.columns
    for i, check in enumerate(checks):
        match check:
            case Between(column):
                metrics.append(F.count_if(~F.col(column).between(check.low, check.high)).alias(f"out{i}"))
            case Unique(column):
                copies = F.count(F.lit(1)).over(Window.partitionBy(*within, column))
                df = df.withColumn(f"_copies{i}", F.when(F.col(column).isNotNull(), copies))
                metrics.append(F.count_if(F.col(f"_copies{i}") > 1).alias(f"out{i}"))
    watched = Observation()
    return df.observe(watched, *metrics).select(*columns), watched


def enforce_metrics(metrics: Observation | None, checks: tuple[Check, ...]) -> None:
    """As ``enforce``, on the metrics that writing a ``measured`` table has left."""
    if metrics is None:
        return
    found, failed = metrics.get, []
    for i, check in enumerate(checks):
        match check:
            case RowCount(low, high) if not low <= found["rows"] <= high:
                failed.append(f"row_count_between(*): {found['rows']} rows")
            case Between(column) | Unique(column) if found[f"out{i}"]:
                name = "values_unique" if isinstance(check, Unique) else "values_between"
                failed.append(f"{name}({column}): {found[f'out{i}']} unexpected")
    if failed:
        raise CheckFailed("; ".join(failed))
