"""The run log and the reports on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.dates import seconds_between
from ..functions.rules import percent
from ..operators.merge import update_by_key, upsert
from ..schemas import RUN_LOG

SOURCE_LABELS = {"adzuna": "Adzuna", "jooble": "Jooble", "remoteok": "RemoteOK", "gupy": "Gupy"}
DATE_FORM, STAMP_FORM = "dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss"
RUNNING_LABEL = "Em Execução..."

RESET = ["started_at", "status", "error_message", "ended_at"]
EXTRACT = ["adzuna_count", "jooble_count", "remoteok_count", "gupy_count", "raw_inserted"]
DEDUP = ["dedup_new", "dedup_duplicates"]
END = ["ended_at", "status", "classified_count", "error_message"]
COUNTERS = [*EXTRACT, *DEDUP, "classified_count"]


# --- writing ------------------------------------------------------------------
def started(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Open runs (execution_date, started_at); a repeated day is reset but keeps its counters."""
    opened = starts.select(
        "execution_date", "started_at",
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit("RUNNING").alias("status"),
        *[F.lit(0).alias(c) for c in COUNTERS],
        F.lit(None).cast("string").alias("error_message"),
    )
    return upsert(log, opened, "execution_date", RESET)


def record(log: DataFrame, changes: DataFrame, columns: list[str]) -> DataFrame:
    """Set ``EXTRACT``, ``DEDUP`` or ``END`` columns of the days in ``changes``."""
    return update_by_key(log, changes, "execution_date", columns)


def change(spark: SparkSession, **values) -> DataFrame:
    """One row of changes, such as the counters of one step."""
    types = {f.name: f for f in StructType.fromDDL(RUN_LOG).fields}
    schema = StructType([types[name] for name in values])
    return spark.createDataFrame([tuple(values.values())], schema)


# --- reading ------------------------------------------------------------------
def status(log: DataFrame) -> DataFrame:
    """The latest run."""
    return log.orderBy(F.col("execution_date").desc()).limit(1)


def dedup_rate(raw: Column, duplicates: Column) -> Column:
    """Share of duplicates in percent, 0 for an empty load."""
    zero = F.lit(0).cast("decimal(20,1)")
    return F.when(raw > 0, percent(duplicates, raw)).otherwise(zero)


def daily_series(log: DataFrame, days: int = 30) -> DataFrame:
    """Rows per source of the last runs."""
    return (
        log.orderBy(F.col("execution_date").desc())
        .limit(days)
        .select(
            F.col("execution_date").alias("day"),
            *[F.col(f"{s}_count").alias(s) for s in SOURCE_LABELS],
            F.col("raw_inserted").alias("total"),
        )
    )


def long_series(series: DataFrame) -> DataFrame:
    """One row per day and source, with the source's label."""
    sources = list(SOURCE_LABELS)
    melted = series.unpivot(["day"], sources, "source", "jobs")
    label = F.col("source")
    for name, text in SOURCE_LABELS.items():
        label = F.when(F.col("source") == name, text).otherwise(label)
    return melted.select("day", label.alias("source"), "jobs")


def history(log: DataFrame, days: int = 30, only: str | None = None) -> DataFrame:
    """The last runs with their duration, optionally of one status."""
    rows = log if only is None else log.filter(F.col("status") == only)
    return (
        rows.orderBy(F.col("execution_date").desc())
        .limit(days)
        .select(
            F.col("execution_date").alias("day"),
            "started_at",
            "ended_at",
            seconds_between(F.col("started_at"), F.col("ended_at")).alias("seconds"),
            "status",
            "raw_inserted",
            "dedup_new",
            "dedup_duplicates",
            "classified_count",
            "error_message",
        )
    )


def history_display(rows: DataFrame) -> DataFrame:
    """Run history as shown: formatted stamps, a running text without end."""
    return rows.select(
        F.date_format("day", DATE_FORM).alias("day"),
        F.date_format("started_at", STAMP_FORM).alias("started"),
        F.coalesce(F.date_format("ended_at", STAMP_FORM), F.lit(RUNNING_LABEL)).alias("ended"),
        "seconds", "status", "raw_inserted", "dedup_new", "dedup_duplicates", "classified_count",
        "error_message",
    )


def latency(rows: DataFrame) -> DataFrame:
    """Seconds of the successful runs, oldest first."""
    return rows.filter(F.col("status") == "SUCCESS").select("day", "seconds").orderBy("day")


# --- unmapped terms -----------------------------------------------------------
def unmapped_ranking(terms: DataFrame, limit: int = 50) -> DataFrame:
    return (
        terms.groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.max("occurred_at").cast("date").alias("last_seen"))
        .orderBy(F.col("occurrences").desc(), "word")
        .limit(limit)
    )


def unmapped_examples(
    terms: DataFrame, jobs: DataFrame, companies: DataFrame, word: str, limit: int = 10
) -> DataFrame:
    """Jobs whose text has the word, by id."""
    hits = terms.filter(F.col("word") == word).select("job_id")
    company = companies.select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    return (
        hits.join(jobs.select("job_id", "title", "company_id", "url"), "job_id")
        .join(company, "company_id")
        .orderBy("job_id")
        .limit(limit)
        .select("job_id", "title", "company", "url")
    )
