"""Declarative checks. Each returns the offending rows or groups; empty means passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for many columns in one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    return composite_unique(df.filter(F.col(column).isNotNull()), [column])


def composite_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups seen more than once, with their size. NULL keys form a group."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child values without a parent, with the number of child rows.

    Child rows are counted per value before the anti join, so a value that
    fills a third of the table meets the join as a single row.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    keys = parent.select(F.col(field_name).alias(column))
    return values.join(keys, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows outside the list; NULL is not a violation."""
    return df.filter(~F.col(column).isin(*values))


def expression_check(df: DataFrame, bad: Column) -> DataFrame:
    return df.filter(bad)


@dataclass(frozen=True)
class Check:
    """One declared check of a model; which fields apply depends on its kind."""

    model: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = ERROR
    parent: str | None = None
    parent_field: str | None = None
    values: tuple[str, ...] = ()
    bad: Callable[[], Column] | None = field(default=None, compare=False)
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}:{','.join(self.columns)}"

    def failing(self, models: Mapping[str, DataFrame]) -> DataFrame:
        df = models[self.model]
        if self.kind == "not_null":
            return not_null(df, self.columns[0])
        if self.kind == "unique":
            return unique(df, self.columns[0])
        if self.kind == "composite_unique":
            return composite_unique(df, self.columns)
        if self.kind == "relationships":
            return relationships(df, self.columns[0], models[self.parent], self.parent_field)
        if self.kind == "accepted_values":
            return accepted_values(df, self.columns[0], self.values)
        if self.kind == "expression":
            return expression_check(df, self.bad())
        raise ValueError(f"unknown check kind {self.kind!r}")

    def failure_count(self, models: Mapping[str, DataFrame]) -> DataFrame:
        """(label, failures): rows for a relationship, otherwise rows or groups returned."""
        count = F.count("*")
        if self.kind == "relationships":
            count = F.coalesce(F.sum("row_count"), F.lit(0))
        return self.failing(models).agg(count.alias("failures"))


def run_checks(models: Mapping[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """(model, check_name, severity, failures, status) of a whole suite.

    All not-null checks of a model share one scan. A warning never fails.
    """
    parts = []
    null_checks: dict[tuple[str, str], list[str]] = {}
    for check in suite:
        if check.kind == "not_null":
            null_checks.setdefault((check.model, check.severity), []).append(check.columns[0])
            continue
        parts.append(
            check.failure_count(models).select(
                F.lit(check.model).alias("model"),
                F.lit(check.label).alias("check_name"),
                F.lit(check.severity).alias("severity"),
                "failures",
            )
        )
    for (model, severity), columns in null_checks.items():
        parts.append(
            null_counts(models[model], columns).select(
                F.lit(model).alias("model"),
                F.concat(F.lit("not_null:"), F.col("column_name")).alias("check_name"),
                F.lit(severity).alias("severity"),
                "failures",
            )
        )
    if not parts:
        nothing = "model string, check_name string, severity string, failures long, status string"
        return SparkSession.active().createDataFrame([], nothing)
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    bad = F.when(F.col("severity") == WARN, "warn").otherwise("fail")
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(bad))
