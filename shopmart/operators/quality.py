"""Column tests. A test reports how many failures it found; none means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared test of one column of a model."""

    model: str
    column: str
    test: str
    # Accepted values, or the SQL condition of an expression test.
    values: tuple[str, ...] = ()
    condition: str = ""


def unique(model: str, column: str) -> Check:
    """Fails once per value that occurs more than once; NULLs are not compared."""
    return Check(model, column, "unique")


def not_null(model: str, column: str) -> Check:
    """Fails once per row without a value."""
    return Check(model, column, "not_null")


def accepted_values(model: str, column: str, values: Sequence[str]) -> Check:
    """Fails once per row with a value outside the list; NULL passes."""
    return Check(model, column, "accepted_values", values=tuple(values))


def expression(model: str, column: str, condition: str) -> Check:
    """Fails once per row for which the SQL condition is false; NULL passes."""
    return Check(model, column, "expression", condition=condition)


def _row_failure(check: Check) -> Column:
    if check.test == "not_null":
        return F.col(check.column).isNull()
    if check.test == "accepted_values":
        return ~F.col(check.column).isin(*check.values)
    return ~F.expr(check.condition)


def _report_row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.test).alias("test"),
        failures.alias("failures"),
    )


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level tests of one table in a single pass without a wide shuffle."""
    counted = df.agg(*[F.count_if(_row_failure(c)).alias(f"f{i}") for i, c in enumerate(checks)])
    rows = F.array(*[_report_row(c, F.col(f"f{i}")) for i, c in enumerate(checks)])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def _unique_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All key tests of one table in one scan and one grouping, by test and value."""
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("k"))
            for i, c in enumerate(checks)
        ]
    )
    values = df.select(F.explode(keys).alias("key")).select("key.*").where(F.col("k").isNotNull())
    counts = values.groupBy("i", "k").agg(F.count(F.lit(1)).alias("n"))
    repeated = [
        F.count_if((F.col("i") == i) & (F.col("n") > 1)).alias(f"f{i}") for i in range(len(checks))
    ]
    rows = F.array(*[_report_row(c, F.col(f"f{i}")) for i, c in enumerate(checks)])
    return counts.agg(*repeated).select(F.explode(rows).alias("r")).select("r.*")


def row_metrics(checks: Sequence[Check]) -> dict[str, Column]:
    """Failures of row-level tests as aggregates by position, for a pass that reads the rows anyway."""
    return {
        f"failures_{i}": F.count_if(_row_failure(c))
        for i, c in enumerate(checks)
        if c.test != "unique"
    }


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report of (model, column_name, test, failures), one row per check."""
    if not checks:
        raise ValueError("no checks to run")
    parts = []
    for kind, run in ((True, _unique_checks), (False, _row_checks)):
        own = [c for c in checks if (c.test == "unique") == kind]
        for model in dict.fromkeys(c.model for c in own):
            parts.append(run(tables[model], [c for c in own if c.model == model]))
    return reduce(DataFrame.unionByName, parts)
