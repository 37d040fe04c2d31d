"""Explicit schemas of the silver and gold tables.  Nothing is inferred."""

from __future__ import annotations

RAW_JOBS = """
    id STRING, source STRING, source_id STRING, title STRING, company STRING,
    location STRING, description STRING, url STRING, posted_at DATE,
    is_remote BOOLEAN, payload STRING, ingested_at TIMESTAMP
"""

COMPANIES = "id STRING, name STRING"

LOCATIONS = "id STRING, raw STRING, city STRING, state STRING, country STRING, is_remote BOOLEAN"

JOBS = """
    job_id STRING, source_ids ARRAY<STRING>, dedup_hash STRING, title STRING,
    company_id STRING, location_id STRING, area STRING, seniority STRING,
    skills ARRAY<STRING>, url STRING, posted_at DATE, is_remote BOOLEAN,
    is_hybrid BOOLEAN, created_at TIMESTAMP, is_active BOOLEAN,
    classification_source STRING
"""

RUN_LOG = """
    execution_date DATE, started_at TIMESTAMP, ended_at TIMESTAMP, status STRING,
    adzuna_count INT, jooble_count INT, remoteok_count INT, gupy_count INT,
    raw_inserted INT, dedup_new INT, dedup_duplicates INT, classified_count INT,
    error_message STRING
"""

UNMAPPED_TERMS = "job_id STRING, word STRING, occurred_at TIMESTAMP"

# Re-aimed inputs: what outside services answered, kept as tables.
LABEL_RESPONSES = "job_id STRING, response STRING"
FETCHED_PAGES = "job_id STRING, status_code INT, final_url STRING, html STRING, error STRING"
