"""Rolling windows from daily partial counts.

Partials are counts per day and group that add up: a window of 30 or 90 days is a sum of its
days, so a new day reads that day's postings only and a shifted window reads none.  They are kept as
Parquet with one partition per day (or month, year where days hold little).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import as_date, since
from ..functions.rules import company_size, percent

UNIT = "_unit"
DAY = "posted_date"


# --- partials: one row per day and group ----------------------------------------
def overview_days(fact: DataFrame) -> DataFrame:
    return fact.groupBy(DAY, "area_code", "seniority_code").agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if("is_remote").alias("remote")
    )


def company_days(staged: DataFrame) -> DataFrame:
    return staged.groupBy(DAY, "company_id").agg(F.count(F.lit(1)).alias("jobs"))


def skill_days(skills: DataFrame) -> DataFrame:
    """From ``gold.job_skills``: a job counts once per skill, and has one day."""
    return skills.groupBy(DAY, "job_area", "skill").agg(F.count("job_id").alias("jobs"))


PARTIALS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "overview": overview_days, "companies": company_days, "skills": skill_days,
}


def _unit(unit: str):
    return F.to_date(F.date_trunc(unit, DAY))


def refresh(rows: DataFrame, partial: str, path: str, first_day: str | None = None, unit: str = "day") -> None:
    """Partials of all days, or anew of those from ``first_day`` on.

    Days before the unit of ``first_day`` are neither read nor written; rows without a date belong to
    no window and are left out.  A day whose postings are all gone keeps its partials, so give the whole
    table (no ``first_day``) after postings were removed.
    """
    dated = rows.filter(F.col(DAY).isNotNull())
    if first_day is not None:
        dated = dated.filter(F.col(DAY) >= F.to_date(F.date_trunc(unit, as_date(first_day))))
    days = PARTIALS[partial](dated).withColumn(UNIT, _unit(unit)).repartition(F.col(UNIT))
    mode = "dynamic" if first_day is not None else "static"
    days.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(UNIT).parquet(path)


def window(spark: SparkSession, path: str, days: int, as_of: str, unit: str = "day") -> DataFrame:
    """The partials of the last ``days`` days; other partitions are not read."""
    first = F.date_sub(as_date(as_of), days)
    held = spark.read.parquet(path).filter(F.col(UNIT) >= F.to_date(F.date_trunc(unit, first)))
    return held.filter(since(F.col(DAY), days, as_of)).drop(UNIT)


# --- figures as sums of days ----------------------------------------------------
def market_overview(partials: DataFrame, as_of: str) -> DataFrame:
    """``agg_market_overview`` of the days given."""
    return (
        partials.groupBy("area_code", "seniority_code")
        .agg(F.sum("jobs").alias("total_jobs"), percent(F.sum("remote"), F.sum("jobs")).alias("pct_remote"))
        .withColumn("reference_date", as_date(as_of))
    )


def company_sizes(partials: DataFrame) -> DataFrame:
    """``int_company_size`` of the days given."""
    volume = partials.groupBy("company_id").agg(F.sum("jobs").alias("total_postings_30d"))
    return volume.withColumn("company_size", company_size(F.col("total_postings_30d")))


def skills_frequency(partials: DataFrame, as_of: str) -> DataFrame:
    """``agg_skills_frequency`` of the days given: the partials themselves."""
    return partials.select(
        "skill", "job_area", F.col(DAY).alias("reference_date"), F.col("jobs").alias("job_count")
    ).withColumn("snapshot_date", as_date(as_of))
