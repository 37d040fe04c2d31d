"""Data-quality checks.  A check returns violation rows; none means it passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from .merge import union_all


# --- violation rows -----------------------------------------------------------
def not_null(table: DataFrame, column: str) -> DataFrame:
    return table.filter(F.col(column).isNull())


def unique(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs do not count."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )


def accepted_values(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with another value; NULL passes."""
    return table.filter(~F.col(column).isin(list(values)))


def relationships(table: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key the parent lacks."""
    keys = parent.select(F.col(key).alias(column))
    return table.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphans(fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """(check_type, key, orphan_id) for foreign keys without parent; NULL is an orphan too.

    NULL keys need no join and would all meet in one partition, so they skip it.
    """
    found = []
    for check, (parent, column) in parents.items():
        rows = fact.select(key, column)
        missing = (
            rows.filter(F.col(column).isNotNull())
            .join(parent.select(column), column, "left_anti")
            .select(key, column)
            .unionByName(rows.filter(F.col(column).isNull()))
        )
        found.append(
            missing.select(F.lit(check).alias("check_type"), key, F.col(column).alias("orphan_id"))
        )
    return union_all(found)


# --- reports ------------------------------------------------------------------
def row_checks(
    table: DataFrame,
    name: str,
    required: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All row-wise checks of a table in one scan: (table, check, column, violations)."""
    counters: list[tuple[str, str, Column]] = [
        ("not_null", c, F.count_if(F.col(c).isNull())) for c in required
    ]
    for c, values in (accepted or {}).items():
        counters.append(("accepted_values", c, F.count_if(~F.col(c).isin(list(values)))))
    totals = table.agg(*[count.alias(f"c{i}") for i, (_, _, count) in enumerate(counters)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (check, column, _) in enumerate(counters)
        ]
    )
    return totals.select(F.inline(rows))


def key_checks(table: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """All uniqueness checks of a table in one scan and one shuffle of its keys."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(keys)])
    repeated = (
        table.select(F.inline(pairs))
        .filter("v IS NOT NULL")
        .groupBy("i", "v")
        .agg((F.count(F.lit(1)) > 1).alias("repeated"))
        .agg(*[F.count_if(F.col("repeated") & (F.col("i") == i)).alias(f"c{i}") for i in range(len(keys))])
    )
    return repeated.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit("unique").alias("check_name"),
                 F.lit(c).alias("column_name"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(keys)
    ])))


def counted(violations: DataFrame, name: str, check: str, column: str) -> DataFrame:
    """The number of violation rows in the shape of ``row_checks``."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        "violations",
    )


def table_report(
    table: DataFrame,
    name: str,
    required: Sequence[str] = (),
    keys: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Violation counts of every declared check of one table."""
    parts = []
    if required or accepted:
        parts.append(row_checks(table, name, required, accepted))
    if keys:
        parts.append(key_checks(table, name, keys))
    for c, (parent, key) in (parents or {}).items():
        parts.append(counted(relationships(table, c, parent, key), name, "relationships", c))
    return union_all(parts)


def freshness(
    table: DataFrame,
    stamp: str,
    as_of: datetime | str | Column,
    warn_hours: int = 25,
    error_hours: int = 48,
) -> DataFrame:
    """(last_seen, age_hours, status) of a table against ``as_of``; an empty table is an error."""
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    age = (now.cast("double") - F.col("last_seen").cast("double")) / 3600
    status = (
        F.when(F.col("last_seen").isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return table.agg(F.max(stamp).alias("last_seen")).select(
        "last_seen", age.alias("age_hours"), status.alias("status")
    )


def missing_sources(
    landed: DataFrame,
    source: str = "source",
    required: Iterable[str] = tuple(V.SOURCES),
    skipped: Iterable[str] = (),
) -> DataFrame:
    """Required sources that did not land; a source skipped on purpose is not required."""
    expected = [(name,) for name in required if name not in set(skipped)]
    wanted = landed.sparkSession.createDataFrame(expected, f"{source} STRING")
    return wanted.join(landed.select(source).distinct(), source, "left_anti")


def require_sources(landed: DataFrame, **options) -> None:
    """Stop the run when a required source is missing."""
    missing = sorted(row[0] for row in missing_sources(landed, **options).collect())
    if missing:
        raise ValueError("sources without landed data: " + ", ".join(missing))
