"""Gold models: staging views, star schema and pre-aggregated marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import fixed_values as V
from ..functions.dates import as_date, since
from ..functions.keys import surrogate_key
from ..functions.rules import company_size, country_code, country_name, percent, skill_category
from ..functions.text import blank_to
from ..operators.merge import incremental


# --- staging ------------------------------------------------------------------
def stg_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("title").isNotNull()).select(
        "job_id",
        surrogate_key(F.col("job_id")).alias("job_sk"),
        "company_id",
        "location_id",
        F.col("title").alias("job_title"),
        F.col("area").alias("job_area"),
        F.col("seniority").alias("job_seniority"),
        F.col("skills").alias("skills_array"),
        F.col("url").alias("job_url"),
        F.col("posted_at").alias("posted_date"),
        F.coalesce("is_remote", F.lit(False)).alias("is_remote"),
        F.coalesce("is_hybrid", F.lit(False)).alias("is_hybrid"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        "source_ids",
        F.col("created_at").alias("ingested_at"),
    )


def stg_companies(companies: DataFrame) -> DataFrame:
    return companies.select(
        F.col("id").alias("company_id"),
        F.coalesce("name", F.lit(V.NO_COMPANY_NAME)).alias("company_name"),
    )


def stg_locations(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("id").alias("location_id"),
        F.coalesce("raw", F.lit(V.NO_LOCATION_NAME)).alias("location_name"),
        "city",
        "state",
        F.coalesce("country", F.lit(V.DEFAULT_COUNTRY)).alias("country"),
        F.coalesce("is_remote", F.lit(False)).alias("is_remote"),
    )


# --- intermediate -------------------------------------------------------------
def int_jobs_classified(staged: DataFrame) -> DataFrame:
    """Active data jobs with area and seniority filled in."""
    return staged.select(
        "job_id", "job_sk", "company_id", "location_id", "job_title", "job_url", "posted_date",
        "is_remote", "is_hybrid", "is_active", "source_ids", "ingested_at",
        blank_to(F.col("job_area"), V.UNKNOWN).alias("area"),
        blank_to(F.col("job_seniority"), V.UNKNOWN).alias("seniority"),
        F.coalesce(F.size("skills_array") > 0, F.lit(False)).alias("has_skills"),
    ).filter(~F.col("area").isin("non_tech", "non_data") & F.col("is_active"))


def int_jobs_with_skills(staged: DataFrame) -> DataFrame:
    """A row per job and skill, inactive and non-data jobs included."""
    return staged.select(
        "job_id", "company_id", "location_id", "job_area", "job_seniority", "posted_date",
        "is_remote", "is_hybrid", F.explode("skills_array").alias("skill"),
    ).withColumn("skill", F.trim("skill")).filter("skill != ''")


def job_skills(staged: DataFrame) -> DataFrame:
    """``int_jobs_with_skills`` with each skill of a job once: repeats go inside the array."""
    return int_jobs_with_skills(
        staged.withColumn("skills_array", F.array_distinct(F.transform("skills_array", F.trim)))
    )


def int_company_size(staged: DataFrame, as_of: str) -> DataFrame:
    volume = (
        staged.filter(since(F.col("posted_date"), 30, as_of))
        .groupBy("company_id")
        .agg(F.count(F.lit(1)).alias("total_postings_30d"))
    )
    return volume.withColumn("company_size", company_size(F.col("total_postings_30d")))


# --- dimensions ---------------------------------------------------------------
def dim_area(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, V.AREAS, ["area_code", "area_label", "area_order"])


def dim_seniority(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, V.SENIORITIES, ["seniority_code", "seniority_label", "order_rank"])


def literal_rows(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A static table as VALUES: part of the plan, no job and no Python to read it."""
    listed = ", ".join(str(row) for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({', '.join(columns)})")


def dim_company(companies: DataFrame, sizes: DataFrame) -> DataFrame:
    return companies.join(sizes, "company_id", "left").select(
        "company_id",
        "company_name",
        F.coalesce("company_size", F.lit(V.SMALLEST_SIZE)).alias("company_size"),
        F.coalesce("total_postings_30d", F.lit(0)).alias("postings_last_30d"),
    )


def dim_location(locations: DataFrame) -> DataFrame:
    coded = locations.select(
        "location_id", "location_name", "is_remote",
        country_code(F.col("location_name")).alias("country_code"),
    )
    return coded.withColumn("country_name", country_name(F.col("country_code")))


def dim_skill(with_skills: DataFrame) -> DataFrame:
    names = with_skills.filter("skill != ''").select(F.col("skill").alias("skill_name")).distinct()
    return names.select(
        surrogate_key(F.col("skill_name")).alias("skill_id"),
        "skill_name",
        F.lower("skill_name").alias("skill_canonical"),
        skill_category(F.col("skill_name")).alias("primary_category"),
    )


# --- fact ---------------------------------------------------------------------
def fact_job_posting(classified: DataFrame, areas: DataFrame, seniorities: DataFrame) -> DataFrame:
    """Codes that a static dimension lacks become NULL.  Both have under ten rows."""
    area = F.broadcast(areas.select("area_code"))
    seniority = F.broadcast(seniorities.select("seniority_code"))
    return (
        classified.join(area, F.col("area") == F.col("area_code"), "left")
        .join(seniority, F.col("seniority") == F.col("seniority_code"), "left")
        .select(
            "job_id", "company_id", "location_id", "area_code", "seniority_code", "job_title",
            "job_url", "posted_date", "is_remote", "is_hybrid", "has_skills", "source_ids",
            "ingested_at",
        )
    )


def load_fact(target: DataFrame | None, rows: DataFrame, mode: str = "append_new") -> DataFrame:
    """First load, later increments, or a full rebuild."""
    return rows if target is None else incremental(target, rows, "job_id", "ingested_at", mode)


# --- marts --------------------------------------------------------------------
def agg_market_overview(fact: DataFrame, as_of: str) -> DataFrame:
    return (
        fact.filter(since(F.col("posted_date"), 30, as_of))
        .groupBy("area_code", "seniority_code")
        .agg(
            F.count(F.lit(1)).alias("total_jobs"),
            percent(F.count_if("is_remote"), F.count(F.lit(1))).alias("pct_remote"),
        )
        .withColumn("reference_date", as_date(as_of))
    )


def agg_skills_frequency(skills: DataFrame, as_of: str) -> DataFrame:
    """Jobs per skill, area and day, from ``job_skills``.

    A job has a skill once, so the one shuffle carries partial counts and a
    frequent skill is no hot key.
    """
    return (
        skills.filter(since(F.col("posted_date"), 90, as_of))
        .groupBy("skill", "job_area", F.col("posted_date").alias("reference_date"))
        .agg(F.count("job_id").alias("job_count"))
        .withColumn("snapshot_date", as_date(as_of))
    )


def area_skill_counts(skills: DataFrame, fact: DataFrame, as_of: str) -> DataFrame:
    """Recent fact jobs per area and skill, from ``job_skills``."""
    recent = fact.filter(since(F.col("posted_date"), 30, as_of)).select("job_id")
    return (
        skills.filter(since(F.col("posted_date"), 30, as_of))
        .select("job_id", "job_area", "skill")
        .join(recent, "job_id")
        .groupBy("job_area", "skill")
        .agg(F.count("job_id").alias("skill_count"))
    )


def top_skills_per_area(skills: DataFrame, fact: DataFrame, as_of: str, k: int = 10) -> DataFrame:
    """The k best ranks of every area; ties share a rank."""
    ranked = Window.partitionBy("job_area").orderBy(F.col("skill_count").desc())
    counts = area_skill_counts(skills, fact, as_of)
    return counts.withColumn("skill_rank", F.rank().over(ranked)).filter(F.col("skill_rank") <= k)


# --- the whole layer ----------------------------------------------------------
class Model(NamedTuple):
    """A model: what it reads (silver tables or models before it) and how it is made of that."""

    reads: tuple[str, ...]
    build: Callable[..., DataFrame]


def models(spark: SparkSession, as_of: str) -> dict[str, Model]:
    """All models, each after those it reads."""
    return {
        "stg_jobs": Model(("jobs",), stg_jobs),
        "stg_companies": Model(("companies",), stg_companies),
        "stg_locations": Model(("locations",), stg_locations),
        "int_jobs_classified": Model(("stg_jobs",), int_jobs_classified),
        "int_jobs_with_skills": Model(("stg_jobs",), int_jobs_with_skills),
        "int_company_size": Model(("stg_jobs",), lambda staged: int_company_size(staged, as_of)),
        "dim_area": Model((), lambda: dim_area(spark)),
        "dim_seniority": Model((), lambda: dim_seniority(spark)),
        "dim_company": Model(("stg_companies", "int_company_size"), dim_company),
        "dim_location": Model(("stg_locations",), dim_location),
        "dim_skill": Model(("int_jobs_with_skills",), dim_skill),
        "fact_job_posting": Model(("int_jobs_classified", "dim_area", "dim_seniority"), fact_job_posting),
        "agg_skills_frequency": Model(("stg_jobs",), lambda staged: agg_skills_frequency(job_skills(staged), as_of)),
        "agg_market_overview": Model(("fact_job_posting",), lambda fact: agg_market_overview(fact, as_of)),
    }


def build_gold(
    spark: SparkSession, silver: Mapping[str, DataFrame], as_of: str, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All models from the silver tables ``jobs``, ``companies`` and ``locations``.

    Plans only, unless ``keep`` is given (a model and its name to what later ones read): with
    ``sources.tables.stored_in`` every model is written and built from the written ones before it, so
    each is planned and computed once, and the silver tables are read by the staging models alone.
    """
    made = dict(silver)
    for name, model in models(spark, as_of).items():
        built = model.build(*[made[r] for r in model.reads])
        made[name] = built if keep is None else keep(built, name)
    return {name: made[name] for name in models(spark, as_of)}


STAGING = ("stg_jobs", "stg_companies", "stg_locations")
