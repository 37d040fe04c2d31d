"""The declared data tests of the gold layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions import fixed_values as V
from ..operators.merge import union_all
from ..operators.quality import orphans, table_report

# --- fixed values: what every model promises ----------------------------------
ALL_SENIORITIES = [code for code, _, _ in V.SENIORITIES]
CHECKS: dict[str, dict] = {
    "stg_jobs": {
        "required": ["job_id", "job_sk", "job_title", "job_area", "job_seniority", "posted_date", "is_remote"],
        "keys": ["job_id", "job_sk"],
        "accepted": {"job_area": V.VALID_AREAS, "job_seniority": ALL_SENIORITIES},
    },
    "stg_companies": {"required": ["company_id", "company_name"], "keys": ["company_id"]},
    "stg_locations": {"required": ["location_id", "location_name"], "keys": ["location_id"]},
    "int_jobs_with_skills": {"required": ["job_id", "skill"]},
    "int_jobs_classified": {
        "required": ["job_id", "area", "seniority"],
        "keys": ["job_id"],
        "accepted": {"area": V.VALID_AREAS, "seniority": ALL_SENIORITIES},
    },
    "int_company_size": {
        "required": ["company_id", "company_size"],
        "keys": ["company_id"],
        "accepted": {"company_size": ["grande", "media", "pequena"]},
    },
    "dim_company": {
        "required": ["company_id", "company_name", "company_size"],
        "keys": ["company_id"],
        "accepted": {"company_size": ["grande", "media", "pequena"]},
    },
    "dim_location": {"required": ["location_id", "location_name"], "keys": ["location_id"]},
    "dim_skill": {
        "required": ["skill_id", "skill_name", "primary_category"],
        "keys": ["skill_id", "skill_name"],
        "accepted": {
            "primary_category": ["data_engineering", "data_science", "analytics_bi", "ml_mlops", "cross_area"]
        },
    },
    "dim_area": {"required": ["area_code", "area_label"], "keys": ["area_code"]},
    "dim_seniority": {"required": ["seniority_code", "order_rank"], "keys": ["seniority_code"]},
    "fact_job_posting": {
        "required": ["job_id", "company_id", "location_id", "area_code", "seniority_code", "posted_date", "job_url"],
        "keys": ["job_id"],
        "accepted": {"area_code": V.VALID_AREAS, "seniority_code": ALL_SENIORITIES},
        "parents": {"company_id": "dim_company", "location_id": "dim_location"},
    },
    "agg_skills_frequency": {"required": ["skill", "job_area", "reference_date", "job_count"]},
    "agg_market_overview": {"required": ["area_code", "total_jobs"]},
}


def report(models: Mapping[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """(table_name, check_name, column_name, violations) of every declared test."""
    parts = []
    for name in names or list(CHECKS):
        declared = dict(CHECKS[name])
        parents = {c: (models[parent], c) for c, parent in declared.pop("parents", {}).items()}
        parts.append(table_report(models[name], name, parents=parents, **declared))
    return union_all(parts)


def fact_orphans(models: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows without company or location."""
    return orphans(
        models["fact_job_posting"],
        {
            "orphan_company": (models["dim_company"], "company_id"),
            "orphan_location": (models["dim_location"], "location_id"),
        },
        "job_id",
    )


def count_declared() -> int:
    """Declared tests including the orphan report."""
    total = 1
    for declared in CHECKS.values():
        total += sum(len(group) for group in declared.values())
    return total
