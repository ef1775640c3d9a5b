"""Declared data checks, run as DataFrame jobs.

All row checks of a table (null, expression, accepted values) share one
aggregation over one scan. Key checks count keys in an aggregation with map-side
combine, so a hot key never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartlake.functions.text import cut

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """One declared check on a column.

    kind: unique, not_null, accepted_values, expression_is_true or relationships.
    argument: the accepted values, the expression to the right of the column, or
    the (model, column) a foreign key points to.
    """

    model: str
    column: str
    kind: str
    severity: str = ERROR
    argument: tuple | str | None = None

    @property
    def test_name(self) -> str:
        """The kind; expressions are told apart by model and column."""
        return f"{self.kind}_{self.model}_{self.column}" if self.kind == "expression_is_true" else self.kind


class GateClosed(RuntimeError):
    """Raised in enforce mode when a layer has failed checks of severity error."""


# Failures of row checks, as SQL aggregates. Text keeps the many small expressions
# of a check run cheap to build.


def null_rows(column: str) -> str:
    return f"count_if(`{column}` IS NULL)"


def false_rows(column: str, condition: str) -> str:
    """Rows where the condition is false; unknown passes."""
    return f"count_if(NOT (`{column}` {condition}))"


def unlisted_values(column: str, accepted: Iterable) -> str:
    """Distinct values outside the accepted ones; null passes."""
    values = ", ".join(_literal(v) for v in accepted)
    return f"count(DISTINCT CASE WHEN `{column}` NOT IN ({values}) THEN `{column}` END)"


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


# Failures of key checks


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their row counts."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null foreign keys without a parent row, with their child row counts.

    Child rows are counted per key before the join: only distinct keys are joined,
    and a key that a third of the rows carry is one row by then.
    """
    counts = (
        child.where(F.col(key).isNotNull())
        .select(F.col(key).alias("foreign_key"))
        .groupBy("foreign_key")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(parent_key).alias("foreign_key"))
    return counts.join(known, "foreign_key", "left_anti")


# Naming and status


def classify_layer(model: Column) -> Column:
    return (
        F.when(model.startswith("stg_"), "silver")
        .when(model.startswith("dim_") | model.startswith("fct_"), "gold")
        .otherwise("unknown")
    )


def _status(severity: Column, failures: Column) -> Column:
    return (
        F.when(failures == 0, "pass").when(severity == WARN, "warn").otherwise("fail")
    )


def _detail(severity: Column, failures: Column) -> Column:
    noun = F.when(failures == 1, " result").otherwise(" results")
    outcome = F.when(severity == WARN, "warn").otherwise("fail")
    text = F.concat(
        F.lit("Got "), failures.cast("string"), noun,
        F.lit(", configured to "), outcome, F.lit(" if != 0"),
    )
    return F.when(failures > 0, cut(text))


# Runner


def _row_check(check: Check) -> str:
    if check.kind == "not_null":
        return null_rows(check.column)
    if check.kind == "expression_is_true":
        return false_rows(check.column, check.argument)
    if check.kind == "accepted_values":
        return unlisted_values(check.column, check.argument)
    raise ValueError(f"unknown check kind {check.kind!r}")


def _as_rows(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """One row of counts f0, f1, ... to one labelled row per check."""
    rows = ", ".join(
        ", ".join(map(_literal, (c.model, c.column, c.test_name, c.severity))) + f", f{i}"
        for i, c in enumerate(checks)
    )
    names = "model_name, column_name, test_name, severity, failures"
    return counts.selectExpr(f"stack({len(checks)}, {rows}) AS ({names})")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row_checks(table: DataFrame, checks: list[Check]) -> DataFrame:
    counts = table.selectExpr(*[f"{_row_check(c)} AS f{i}" for i, c in enumerate(checks)])
    return _as_rows(counts, checks)


def _key_rows(table: DataFrame, keys: list[tuple[int, str, bool]]) -> DataFrame:
    """One row per row of the table and (check, key column, whether it is the parent's) without null keys.

    All keys of a table come from one scan, however many checks ask for them.
    """
    rows = ", ".join(f"{number}, CAST(`{key}` AS STRING), {0 if parent else 1}L, {str(parent).lower()}" for number, key, parent in keys)
    stacked = table.selectExpr(f"stack({len(keys)}, {rows}) AS (check_no, key, child_rows, is_parent)")
    return stacked.where("key IS NOT NULL")


def _key_checks(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All unique and foreign-key checks in one aggregation per (check, key).

    A key fails a unique check when it has more than one row, and a foreign-key
    check with all its rows when no parent row carries it. No join is needed, and
    rows combine before the only wide exchange.
    """
    keys: dict[str, list[tuple[int, str, bool]]] = {}
    for number, check in enumerate(checks):
        keys.setdefault(check.model, []).append((number, check.column, False))
        if check.kind == "relationships":
            parent, parent_key = check.argument
            keys.setdefault(parent, []).append((number, parent_key, True))
    rows = [_key_rows(tables[model], wanted) for model, wanted in keys.items()]
    per_key = (
        _union(rows)
        .groupBy("check_no", "key")
        .agg(F.sum("child_rows").alias("n"), F.bool_or("is_parent").alias("known"))
    )

    def failures(number: int, check: Check) -> str:
        failed = "n > 1 THEN 1" if check.kind == "unique" else "NOT known THEN n"
        total = f"sum(CASE WHEN check_no = {number} AND {failed} END)"
        return f"CAST(coalesce({total}, 0) AS BIGINT) AS f{number}"

    return _as_rows(per_key.selectExpr(*[failures(i, c) for i, c in enumerate(checks)]), checks)


def count_failures(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check with its number of failures."""
    checks = list(checks)
    if not checks:
        raise ValueError("no checks given")
    by_key = [c for c in checks if c.kind in ("unique", "relationships")]
    by_row = [c for c in checks if c not in by_key]
    parts = [
        _row_checks(tables[model], [c for c in by_row if c.model == model])
        for model in dict.fromkeys(c.model for c in by_row)
    ]
    if by_key:
        parts.append(_key_checks(tables, by_key))
    return _union(parts)


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check],
    run_id: str,
    tested_at: datetime | None = None,
) -> DataFrame:
    """Result rows of all checks: counts, status and message."""
    counted = count_failures(tables, checks)
    severity, failures = F.col("severity"), F.coalesce("failures", F.lit(0))
    return counted.select(
        F.lit(run_id).alias("run_id"),
        classify_layer(F.col("model_name")).alias("layer"),
        "model_name",
        "column_name",
        "test_name",
        "severity",
        _status(severity, failures).alias("status"),
        failures.alias("failure_count"),
        _detail(severity, failures).alias("error_detail"),
        F.lit(tested_at).cast("timestamp").alias("tested_at"),
    )


def to_log(results: DataFrame, attempt: int = 1) -> DataFrame:
    """Results in the columns of the check log."""
    return results.select(
        "run_id", "layer", "model_name", "test_name", "status",
        F.col("failure_count").cast("bigint").alias("failure_count"),
        "error_detail", "tested_at", F.lit(attempt).alias("attempt"),
    )


def gate(results: DataFrame) -> DataFrame:
    """Per layer: checks, failed, warned, and whether the next layer may be built."""
    status = F.col("status")
    failed = F.count_if(status.isin("fail", "error"))
    return results.groupBy("run_id", "layer").agg(
        F.count(F.lit(1)).alias("checks"),
        failed.alias("failed"),
        F.count_if(status == "warn").alias("warned"),
        (failed == 0).alias("open"),
    )


def enforce(results: DataFrame, layer: str, mode: str = "log_only") -> None:
    """Stops the run on failed checks in `enforce` mode; `log_only` lets it go on."""
    if mode not in ("log_only", "enforce"):
        raise ValueError(f"gate mode must be log_only or enforce, not {mode!r}")
    if mode == "enforce":
        closed = gate(results.where(F.col("layer") == layer)).where(~F.col("open")).head(1)
        if closed:
            raise GateClosed(f"{layer}: {closed[0]['failed']} checks failed")
