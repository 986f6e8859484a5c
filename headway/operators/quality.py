"""Declarative data rules. Every rule gives one row with the number of failures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions.columns import pct

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    table: str
    columns: tuple[str, ...]
    severity: str = ERROR

    @property
    def kind(self) -> str:
        return type(self).__name__


@dataclass(frozen=True)
class NotNull(Rule):
    def fails(self) -> Column:
        return F.col(self.columns[0]).isNull()


@dataclass(frozen=True)
class AcceptedValues(Rule):
    """Null passes."""

    values: tuple = ()

    def fails(self) -> Column:
        return ~F.col(self.columns[0]).isin(list(self.values))


@dataclass(frozen=True)
class AcceptedRange(Rule):
    """Both ends belong to the range; null passes."""

    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        return ~F.col(self.columns[0]).between(self.low, self.high)


@dataclass(frozen=True)
class Unique(Rule):
    """No two rows share the columns. For a single column nulls are ignored."""


@dataclass(frozen=True)
class Relationship(Rule):
    """Every non-null value exists in the parent."""

    parent: str = ""
    parent_column: str = ""


_RESULT = ["table", "rule", "columns", "severity", "failures"]


def _describe(rule: Rule) -> list[Column]:
    return [
        F.lit(rule.table).alias("table"),
        F.lit(rule.kind).alias("rule"),
        F.lit(",".join(rule.columns)).alias("columns"),
        F.lit(rule.severity).alias("severity"),
    ]


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules that look at one row at a time, in one pass over the table."""
    counts = df.agg(*[F.count_if(r.fails()).alias(f"r{i}") for i, r in enumerate(rules)])
    results = [
        F.struct(*_describe(r), F.col(f"r{i}").alias("failures")) for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*results)))


def _duplicates(df: DataFrame, rule: Rule) -> DataFrame:
    """Number of column values that occur more than once."""
    if len(rule.columns) == 1:
        df = df.filter(F.col(rule.columns[0]).isNotNull())
    sizes = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count_if(F.col("n") > 1).alias("failures"))


def unmatched(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row and how many rows have each. Values are counted before the join,
    so one frequent value does not weigh on it."""
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def check_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: table, rule, columns, severity, failures, status (pass, warn or fail)."""
    parts = []
    by_row: dict[str, list[Rule]] = {}
    for rule in rules:
        df = tables[rule.table]
        if isinstance(rule, Unique):
            found = _duplicates(df, rule)
        elif isinstance(rule, Relationship):
            missing = unmatched(df, rule.columns[0], tables[rule.parent], rule.parent_column)
            found = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
        else:
            by_row.setdefault(rule.table, []).append(rule)
            continue
        parts.append(found.select(*_describe(rule), "failures"))
    parts += [_row_rules(tables[name], group).select(*_RESULT) for name, group in by_row.items()]
    report = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == WARN, "warn")
        .otherwise("fail")
    )
    return report.select("*", status.alias("status"))


def _minutes_since(newest: Column, now: dt.datetime | Column) -> Column:
    at = now if isinstance(now, Column) else F.lit(now)
    return (F.unix_micros(at.cast("timestamp")) - F.unix_micros(newest)) / F.lit(60_000_000)


def freshness(
    sources: Mapping[str, DataFrame],
    now: dt.datetime | Column,
    *,
    warn_minutes: float = C.FRESHNESS_WARN_MINUTES,
    error_minutes: float = C.FRESHNESS_ERROR_MINUTES,
) -> DataFrame:
    """Age of the newest row of each source. A source without rows is an error."""
    parts = [
        df.agg(F.max("_ingested_at").alias("newest")).select(F.lit(name).alias("source"), "newest")
        for name, df in sources.items()
    ]
    age = _minutes_since(F.col("newest"), now)
    status = (
        F.when(F.col("age_minutes").isNull() | (F.col("age_minutes") > error_minutes), "error")
        .when(F.col("age_minutes") > warn_minutes, "warn")
        .otherwise("pass")
    )
    aged = reduce(DataFrame.unionByName, parts).withColumn("age_minutes", age)
    return aged.select("source", "newest", "age_minutes", status.alias("status"))


def pipeline_health(
    fact: DataFrame,
    now: dt.datetime | Column,
    *,
    max_hours: float = C.MAX_HOURS_SINCE_INGEST,
    max_orphan_pct: float = C.MAX_ORPHAN_PCT,
    min_rows: int = C.MIN_ROWS_FOR_ORPHAN_CHECK,
) -> DataFrame:
    """One row per problem: no data at all, no recent data, or a latest day that mostly fails to match the
    timetable. No rows means healthy."""
    newest = F.col("newest")
    hours = _minutes_since(newest, now) / F.lit(60)
    no_service_date = F.lit(None).cast("string").alias("service_date")
    age = (
        fact.agg(F.max("_ingested_at").alias("newest"))
        .select(
            F.when(newest.isNull(), "no_data").when(hours > max_hours, "stale").alias("problem"),
            no_service_date,
            hours.alias("value"),
        )
        .filter(F.col("problem").isNotNull())
    )
    last_day = fact.agg(F.max("service_date")).scalar()
    latest = (
        fact.filter(F.col("service_date") == last_day)
        .groupBy("service_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            pct(F.count_if("is_orphan_trip"), F.count(F.lit(1))).alias("orphan_pct"),
        )
    )
    orphans = latest.filter((F.col("n") >= min_rows) & (F.col("orphan_pct") > max_orphan_pct))
    return age.unionByName(
        orphans.select(
            F.lit("orphans").alias("problem"), "service_date", F.col("orphan_pct").alias("value")
        )
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
