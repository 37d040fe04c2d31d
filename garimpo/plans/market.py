"""Search and market reports over the gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.dates import since
from ..functions.rules import mode_label, percent, seniority_label

Gold = Mapping[str, DataFrame]

MODES = {
    "remote": lambda: F.col("is_remote"),
    "hybrid": lambda: F.col("is_hybrid"),
    "onsite": lambda: ~F.col("is_remote") & ~F.col("is_hybrid"),
}


# --- predicates ---------------------------------------------------------------
def in_list(column: Column, values: Sequence[str]) -> Column:
    return column.isin(list(values))


def in_modes(modes: Sequence[str]) -> Column:
    """Any of ``remote``, ``hybrid``, ``onsite``."""
    return reduce(or_, [MODES[m]() for m in modes])


def text_matches(columns: Sequence[Column], term: str, mode: str = "like") -> Column:
    """Case-insensitive substring in any column.

    ``like`` lets % and _ in the term act as wildcards; ``plain`` takes them literally.
    """
    lowered = [F.lower(c) for c in columns]
    if mode == "like":
        return reduce(or_, [c.like(f"%{term.lower()}%") for c in lowered])
    return reduce(or_, [c.contains(term.lower()) for c in lowered])


def has_all(array: Column, values: Sequence[str]) -> Column:
    """Every value is in the array; a NULL array has none."""
    wanted = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.size(F.array_except(wanted, array)) == 0, F.lit(False))


# --- search -------------------------------------------------------------------
def search(
    gold: Gold,
    jobs: DataFrame,
    as_of: str,
    areas: Sequence[str] = (),
    seniorities: Sequence[str] = (),
    locations: Sequence[str] = (),
    modes: Sequence[str] = (),
    skills: Sequence[str] = (),
    days: int | None = None,
    term: str = "",
    limit: int | None = 201,
    term_mode: str = "like",
) -> DataFrame:
    """Newest postings that fulfil every given filter.

    Filters on the fact's own columns are applied before the joins and reach
    its scan.  The skills come from the silver jobs.
    """
    fact = gold["fact_job_posting"]
    if areas:
        fact = fact.filter(in_list(F.col("area_code"), areas))
    if seniorities:
        fact = fact.filter(in_list(F.col("seniority_code"), seniorities))
    if modes:
        fact = fact.filter(in_modes(modes))
    if days:
        fact = fact.filter(since(F.col("posted_date"), days, as_of))
    place = gold["dim_location"].select("location_id", "location_name", "country_name")
    if locations:
        place = place.filter(
            in_list(F.col("location_name"), locations) | in_list(F.col("country_name"), locations)
        )
    joined = (
        fact.join(F.broadcast(gold["dim_area"]), "area_code")
        .join(F.broadcast(gold["dim_seniority"]), "seniority_code")
        .join(place, "location_id")
        .join(gold["dim_company"].select("company_id", "company_name"), "company_id")
    )
    if term:
        joined = joined.filter(text_matches([F.col("job_title"), F.col("company_name")], term, term_mode))
    owned = jobs.select("job_id", "skills")
    newest = [F.col("posted_at").desc_nulls_first(), F.col("job_id")]
    if skills:
        joined = joined.join(owned.filter(has_all(F.col("skills"), skills)), "job_id")
    rows = joined.select(
        "job_id",
        F.col("job_title").alias("title"),
        F.col("company_name").alias("company"),
        F.col("location_name").alias("location"),
        F.col("area_label").alias("area"),
        F.col("order_rank").alias("seniority_rank"),
        seniority_label(F.col("seniority_code")).alias("seniority"),
        *(["skills"] if skills else []),
        F.col("job_url").alias("url"),
        F.col("posted_date").alias("posted_at"),
        "is_remote",
        "is_hybrid",
    )
    if limit is not None:
        rows = rows.orderBy(*newest).limit(limit)
    if skills:
        return rows
    if limit is None:
        return _in_order(rows.join(owned, "job_id", "left"))
    return _in_order(_page_skills(rows, owned)).orderBy(*newest)


def _page_skills(page: DataFrame, owned: DataFrame) -> DataFrame:
    """The limited rows with their jobs' skills.

    The page is broadcast to the jobs, which keep the skills of its ids only; nothing runs before the
    caller asks for rows, and the filters behind the page still reach the fact's scan.
    """
    named = owned.join(F.broadcast(page.select("job_id")), "job_id", "left_semi")
    return page.join(F.broadcast(named), "job_id", "left")


def _in_order(rows: DataFrame) -> DataFrame:
    before = rows.columns[: rows.columns.index("url")]
    before = [c for c in before if c != "skills"]
    return rows.select(*before, "skills", *[c for c in rows.columns if c not in before and c != "skills"])


def with_overflow(found: DataFrame, shown: int = 200) -> tuple[DataFrame, DataFrame]:
    """Rows to show and one row telling the count label.  ``found`` has at most shown + 1 rows."""
    order = [F.col("posted_at").desc_nulls_first(), F.col("job_id")]
    total = found.agg(F.count(F.lit(1)).alias("_n")).select(
        F.least("_n", F.lit(shown)).alias("shown"),
        (F.col("_n") > shown).alias("overflow"),
        F.when(F.col("_n") > shown, F.lit(f"{shown}+")).otherwise(F.col("_n").cast("string")).alias("label"),
    )
    return found.orderBy(*order).limit(shown), total


def cards(found: DataFrame) -> DataFrame:
    """What a result card shows."""
    listed = F.array_join("skills", ", ")
    return found.select(
        "job_id", "title", "company", "location", "area", "seniority", "url",
        mode_label(F.col("is_remote"), F.col("is_hybrid"), V.MODE_TAGS).alias("mode_tag"),
        F.when(F.size("skills") > 0, listed).otherwise(V.NO_SKILLS_LABEL).alias("skills_text"),
        F.coalesce(F.date_format("posted_at", "dd/MM"), F.lit("")).alias("posted_text"),
    )


def digest(gold: Gold, day: str, limit: int = 10) -> DataFrame:
    """The first postings of one day."""
    return (
        gold["fact_job_posting"]
        .filter(F.col("posted_date") == F.lit(day).cast("date"))
        .join(F.broadcast(gold["dim_area"]), "area_code")
        .join(gold["dim_location"].select("location_id", "location_name"), "location_id")
        .join(gold["dim_company"].select("company_id", "company_name"), "company_id")
        .orderBy("job_id")
        .limit(limit)
        .select(
            F.col("job_title").alias("title"),
            F.col("company_name").alias("company"),
            F.col("location_name").alias("location"),
            F.col("area_label").alias("area"),
            mode_label(F.col("is_remote"), F.col("is_hybrid"), V.DIGEST_MODES).alias("mode"),
            F.col("job_url").alias("url"),
        )
    )


# --- filter options -----------------------------------------------------------
def area_options(gold: Gold) -> DataFrame:
    return gold["dim_area"].select("area_code", "area_label").orderBy("area_label")


def seniority_options(gold: Gold) -> DataFrame:
    return gold["dim_seniority"].select("seniority_code", "order_rank").orderBy("order_rank")


def location_options(gold: Gold) -> DataFrame:
    """Names and countries of the locations that occur in the fact."""
    used = gold["dim_location"].join(
        gold["fact_job_posting"].select("location_id"), "location_id", "left_semi"
    )
    names = used.filter(F.col("location_name") != V.UNKNOWN_LOCATION).select(
        F.col("location_name").alias("name")
    )
    countries = used.filter(F.col("country_name").isNotNull()).select(F.col("country_name").alias("name"))
    return names.union(countries).distinct().orderBy("name")


def skill_options(gold: Gold) -> DataFrame:
    return gold["dim_skill"].select("skill_name").distinct().orderBy("skill_name")


# --- market reports -----------------------------------------------------------
def kpis(fact: DataFrame, as_of: str) -> DataFrame:
    """Totals and shares in one pass; shares of an empty fact are 0."""
    total = F.count(F.lit(1))
    zero = F.lit(0).cast("decimal(20,1)")
    return fact.agg(
        total.alias("total_jobs"),
        F.coalesce(percent(F.count_if("is_remote"), total), zero).alias("pct_remote"),
        F.coalesce(percent(F.count_if("is_hybrid"), total), zero).alias("pct_hybrid"),
        F.count_if(since(F.col("posted_date"), 1, as_of)).alias("jobs_today"),
    )


def by_area(gold: Gold) -> DataFrame:
    """Jobs per area label.  Codes are counted before the labels are joined."""
    counts = gold["fact_job_posting"].groupBy("area_code").agg(F.count("job_id").alias("jobs"))
    return (
        counts.join(F.broadcast(gold["dim_area"]), "area_code")
        .select(F.col("area_label").alias("area"), "jobs")
        .orderBy(F.col("jobs").desc(), "area")
    )


def by_seniority(gold: Gold) -> DataFrame:
    counts = gold["fact_job_posting"].groupBy("seniority_code").agg(F.count("job_id").alias("jobs"))
    return (
        counts.join(F.broadcast(gold["dim_seniority"]), "seniority_code")
        .select(seniority_label(F.col("seniority_code")).alias("seniority"), "order_rank", "jobs")
        .orderBy("order_rank")
    )


def modes_by_area(gold: Gold) -> DataFrame:
    counts = gold["fact_job_posting"].groupBy("area_code").agg(
        F.count_if("is_remote").alias("remote"),
        F.count_if("is_hybrid").alias("hybrid"),
        F.count_if(~F.col("is_remote") & ~F.col("is_hybrid")).alias("onsite"),
    )
    return counts.join(F.broadcast(gold["dim_area"]), "area_code").select(
        F.col("area_label").alias("area"), "remote", "hybrid", "onsite"
    )


def top_skills(frequency: DataFrame, area_code: str | None = None, limit: int = 15) -> DataFrame:
    rows = frequency if area_code is None else frequency.filter(F.col("job_area") == area_code)
    return (
        rows.groupBy("skill")
        .agg(F.sum("job_count").alias("frequency"))
        .orderBy(F.col("frequency").desc(), "skill")
        .limit(limit)
    )


def skills_heatmap(gold: Gold, k: int = 10) -> DataFrame:
    """Area counts of the k most frequent skills.

    The ranking reads the area counts, so both sides share one exchange.  The join of the
    k rows is left to their size.
    """
    counts = gold["agg_skills_frequency"].groupBy("skill", "job_area").agg(F.sum("job_count").alias("frequency"))
    best = top_skills(counts.withColumnRenamed("frequency", "job_count"), limit=k).select("skill")
    counts = counts.join(best, "skill", "left_semi")
    area = F.broadcast(gold["dim_area"].select("area_code", F.col("area_label").alias("area")))
    return counts.join(area, F.col("job_area") == F.col("area_code")).select("skill", "area", "frequency")
