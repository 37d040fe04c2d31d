"""All silver steps and the gold layer, one after the other."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from garimpo.plans import checks, gold, market, silver
from garimpo.schemas import COMPANIES, FETCHED_PAGES, JOBS, LABEL_RESPONSES, LOCATIONS, RAW_JOBS
from garimpo.sources import envelopes as E

POSTINGS = [
    ("jooble", {"id": 1, "title": "Engenheiro de Dados Sênior", "company": "Acme", "location": "São Paulo - SP",
                "snippet": "Python, SQL e Airflow. Trabalho remoto.", "link": "http://x/1", "updated": "2026-05-20"}),
    ("gupy", {"source_id": "g1", "title": "Senior Engenheiro de Dados", "company": "ACME", "location": "SP",
              "raw_text": "Python", "url": "http://x/2", "posted_at": "2026-05-20", "is_remote": False}),
    ("jooble", {"id": 2, "title": "Estagiário de TI", "company": "Beta", "location": "London",
                "snippet": "Python e banco de dados SQL com Qdrant", "link": "http://x/3", "updated": "2026-05-19"}),
    ("jooble", {"id": 3, "title": "Comprador de Insumos", "company": "Beta", "location": "London",
                "snippet": "cotações", "link": "http://x/4", "updated": "2026-05-19"}),
    ("jooble", {"id": 4, "title": "Analista de Dados Pleno", "company": "Beta", "location": "London",
                "snippet": "Power BI", "link": "http://x/5", "updated": "2026-04-01"}),
    ("jooble", {"id": 5, "title": "Data Scientist", "company": "Gama", "location": "Remote",
                "snippet": "pandas", "link": "http://x/6", "updated": "2026-05-18"}),
]


def test_whole_run(spark):
    at, day, as_of, run_at = datetime(2026, 5, 21, 6), date(2026, 5, 21), "2026-05-21", "2026-05-21 06:00:00"
    landing = spark.createDataFrame(
        [(s, day, at, json.dumps(p, ensure_ascii=False)) for s, p in POSTINGS], E.ROW_SCHEMA
    ).withColumn("ingested_at", F.col("extracted_at"))
    loaded = silver.load(landing, spark.createDataFrame([], RAW_JOBS))
    empty = [spark.createDataFrame([], schema) for schema in (JOBS, COMPANIES, LOCATIONS)]
    resolved = silver.resolve(loaded.raw, *empty, run_at)
    assert resolved.stats.collect()[0].asDict() == {"new": 5, "duplicate": 1, "skipped": 0}

    classified = silver.classify(resolved.jobs, loaded.raw, run_at)
    assert classified.stats.collect()[0].asDict() == {"classified": 5, "area_unknown": 1, "seniority_unknown": 2}
    assert {r["word"] for r in classified.unmapped.collect()} == {"Trabalho", "Qdrant", "Power", "BI"}
    jobs = classified.jobs.cache()
    by_title = {r["title"]: r for r in jobs.collect()}
    engineer = next(r for t, r in by_title.items() if "Engenheiro" in t)
    assert (engineer["area"], engineer["seniority"]) == ("data_engineering", "senior")
    assert sorted(engineer["source_ids"]) == ["1", "g1"]
    assert by_title["Estagiário de TI"]["classification_source"] == "syntax"

    unsure = jobs.withColumn(
        "classification_source",
        F.when(F.col("title") == "Estagiário de TI", "unknown").otherwise(F.col("classification_source")),
    )
    answer = [(by_title["Estagiário de TI"]["job_id"], '{"area": "bi", "seniority": "estagio"}')]
    labelled = silver.apply_labels(unsure, spark.createDataFrame(answer, LABEL_RESPONSES), as_of)
    pages = [(by_title["Data Scientist"]["job_id"], 200, "http://x/6", "Esta vaga foi FINALIZADA", None)]
    expired = silver.expire(labelled.jobs, spark.createDataFrame(pages, FETCHED_PAGES), as_of)
    assert expired.stats.collect()[0].asDict() == {"expired_by_age": 1, "tested": 4, "expired_by_link": 1}

    tables = {"jobs": expired.jobs, "companies": resolved.companies, "locations": resolved.locations}
    models = gold.build_gold(spark, tables, as_of)
    found = market.search(models, expired.jobs, as_of).collect()
    assert [(r["area"], r["seniority"]) for r in found] == [
        ("Engenharia de Dados", "Sênior"), ("Business Intelligence", "Estágio")]
    assert checks.fact_orphans(models).count() == 0
    assert {r["violations"] for r in checks.report(models, ["fact_job_posting", "dim_company"]).collect()} == {0}
