"""Star schema, search and quality on small tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from garimpo.operators import quality as Q
from garimpo.plans import checks, gold as G, market as K, runs as R
from garimpo.schemas import COMPANIES, JOBS, LOCATIONS

AS_OF = "2026-05-21"


def full_plan(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def silver(spark):
    def job(i, title, company, area, level, skills, posted, remote=None, hybrid=None, active=None):
        return (str(i), [f"s{i}"], f"h{i}", title, company, "l1", area, level, skills, f"http://x/{i}", posted,
                remote, hybrid, datetime(2026, 5, 20, i), active, "syntax")

    day = date(2026, 5, 20)
    jobs = [job(i, f"Data {i}", "c1", "bi", "senior", ["SQL", " dbt "], day, remote=i % 2 == 0) for i in range(1, 11)]
    jobs += [
        job(11, "No area", "c2", None, " ", None, day, hybrid=True),
        job(12, "Old", "c2", "bi", "junior", ["R", ""], date(2026, 1, 1)),
        job(13, "Other", "c2", "non_tech", "junior", ["Excel"], day),
        job(14, "Closed", "c3", "bi", "junior", [], day, active=False),
        job(15, None, "c3", "bi", "junior", [], day),
        job(16, "No date", "c3", "weird", "especialista", [], None),
    ]
    return {
        "jobs": spark.createDataFrame(jobs, JOBS),
        "companies": spark.createDataFrame([("c1", "Acme"), ("c2", None), ("c3", "Zed")], COMPANIES),
        "locations": spark.createDataFrame([("l1", "London", None, None, None, None), ("l2", None, None, None, None, True)], LOCATIONS),
    }


@pytest.fixture(scope="module")
def models(spark, silver):
    return {name: df.cache() for name, df in G.build_gold(spark, silver, AS_OF).items()}


def test_fact_and_dimensions(models):
    assert len(models) == 14
    fact = {r["job_id"]: r for r in models["fact_job_posting"].collect()}
    assert set(fact) == {*map(str, range(1, 13)), "16"}
    assert (fact["11"]["area_code"], fact["11"]["seniority_code"], fact["11"]["has_skills"]) == ("unknown", "unknown", False)
    assert fact["16"]["area_code"] is None and fact["1"]["has_skills"]
    companies = {r["company_id"]: tuple(r)[1:] for r in models["dim_company"].collect()}
    assert companies == {"c1": ("Acme", "grande", 10), "c2": ("Empresa nao informada", "pequena", 2),
                         "c3": ("Zed", "pequena", 1)}
    places = {r["location_id"]: r for r in models["dim_location"].collect()}
    assert places["l1"]["country_name"] == "Reino Unido" and places["l2"]["location_name"] == "Nao informado"
    assert {r["skill_name"] for r in models["dim_skill"].collect()} == {"SQL", "dbt", "R", "Excel"}


def test_marts(models):
    overview = {(r["area_code"], r["seniority_code"]): r for r in models["agg_market_overview"].collect()}
    assert float(overview["bi", "senior"]["pct_remote"]) == 50.0 and overview["bi", "senior"]["total_jobs"] == 10
    assert ("bi", "junior") not in overview
    top = G.top_skills_per_area(G.job_skills(models["stg_jobs"]), models["fact_job_posting"], AS_OF, k=1)
    assert {(r["job_area"], r["skill"], r["skill_rank"]) for r in top.collect()} == {("bi", "SQL", 1), ("bi", "dbt", 1)}
    kpis = K.kpis(models["fact_job_posting"], AS_OF).collect()[0]
    assert (kpis["total_jobs"], float(kpis["pct_remote"]), kpis["jobs_today"]) == (13, 38.5, 11)
    empty = K.kpis(models["fact_job_posting"].limit(0), AS_OF).collect()[0]
    assert (empty["total_jobs"], float(empty["pct_remote"])) == (0, 0.0)


def test_search(models, silver):
    def ids(**filters):
        return [r["job_id"] for r in K.search(models, silver["jobs"], AS_OF, **filters).collect()]

    assert ids()[0] == "1" and len(ids()) == 12  # unknown area code falls out of the inner join
    assert ids(skills=["SQL"], modes=["remote"]) == ["10", "2", "4", "6", "8"]
    assert ids(modes=["hybrid"]) == ["11"] and ids(term="no AREA") == ["11"]
    assert ids(term="n_ area") == ["11"] and ids(term="n_ area", term_mode="plain") == []
    assert ids(locations=["Reino Unido"], seniorities=["junior"]) == ["12"]
    assert ids(days=30, areas=["unknown"]) == ["11"] and ids(skills=["none"]) == []
    shown, label = K.with_overflow(K.search(models, silver["jobs"], AS_OF, limit=4), shown=3)
    assert shown.count() == 3 and label.collect()[0].asDict() == {"shown": 3, "overflow": True, "label": "3+"}
    card = {r["job_id"]: r for r in K.cards(K.search(models, silver["jobs"], AS_OF)).collect()}
    assert (card["11"]["mode_tag"], card["11"]["skills_text"], card["11"]["posted_text"]) == ("Hibrido", "Nao mapeada", "20/05")


def test_search_filters_reach_the_scan(spark, silver, tmp_path):
    from garimpo.sources.tables import materialise

    stored = materialise(G.build_gold(spark, silver, AS_OF), str(tmp_path))
    found = K.search(stored, silver["jobs"], AS_OF, areas=["bi"], days=30)
    plan = full_plan(spark, found)
    assert "PushedFilters: [In(area_code" in plan or "EqualTo(area_code,bi)" in plan
    assert "GreaterThanOrEqual(posted_date,2026-04-21)" in plan
    assert "TakeOrderedAndProject" in plan


def test_declared_checks(models):
    assert checks.count_declared() == 68
    report = {(r["table_name"], r["check_name"], r["column_name"]): r["violations"]
              for r in checks.report(models).collect()}
    assert len(report) == 67
    failed = {k: v for k, v in report.items() if v}
    assert failed == {
        ("stg_jobs", "accepted_values", "job_area"): 2, ("stg_jobs", "accepted_values", "job_seniority"): 1,
        ("stg_jobs", "not_null", "job_area"): 1, ("stg_jobs", "not_null", "posted_date"): 1,
        ("int_jobs_classified", "accepted_values", "area"): 1,
        ("fact_job_posting", "not_null", "area_code"): 1, ("fact_job_posting", "not_null", "posted_date"): 1,
    }
    assert checks.fact_orphans(models).count() == 0


def test_other_checks(spark):
    at = spark.createDataFrame([(datetime(2026, 5, 20),)], "t timestamp")
    for now, state in [("2026-05-21 00:00:00", "pass"), ("2026-05-21 02:00:00", "warn"), ("2026-05-23 00:00:00", "error")]:
        assert Q.freshness(at, "t", now).collect()[0]["status"] == state
    assert Q.freshness(at.limit(0), "t", "2026-05-21 00:00:00").collect()[0]["status"] == "error"
    landed = spark.createDataFrame([("adzuna",), ("remoteok",)], "source string")
    with pytest.raises(ValueError, match="gupy, jooble"):
        Q.require_sources(landed)
    with pytest.raises(ValueError, match="gupy$"):
        Q.require_sources(landed, skipped=["jooble"])
    nulls = spark.createDataFrame([("f1", None), ("f2", "p")], "k string, fk string")
    parent = spark.createDataFrame([("p",)], "fk string")
    assert [tuple(r) for r in Q.orphans(nulls, {"o": (parent, "fk")}, "k").collect()] == [("o", "f1", None)]
    assert Q.relationships(nulls, "fk", parent, "fk").count() == 0


def test_run_reports(spark):
    rows = [(date(2026, 5, d), None, None, "SUCCESS", 1, 2, 3, 4, 10, 7, 3, 7, None) for d in (1, 2, 3)]
    from garimpo.schemas import RUN_LOG

    log = spark.createDataFrame(rows, RUN_LOG)
    long = R.long_series(R.daily_series(log, 2)).collect()
    assert len(long) == 8 and {r["source"] for r in long} == {"Adzuna", "Jooble", "RemoteOK", "Gupy"}
    assert R.history_display(R.history(log)).collect()[0]["ended"] == "Em Execução..."
    rate = log.select(R.dedup_rate(F.col("raw_inserted"), F.col("dedup_duplicates")).alias("r"),
                      R.dedup_rate(F.lit(0), F.lit(0)).alias("z")).collect()[0]
    assert (float(rate["r"]), float(rate["z"])) == (30.0, 0.0)
