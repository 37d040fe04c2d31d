"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import quality as Q
from ..plans import checks
from ..plans import gold as G
from ..session import shared_folder
from ..sources.tables import stored_in
from . import stand_ins as S
from .registry import query, table

SQL_NAMES = {
    "fact_job_posting": "fact",
    "agg_skills_frequency": "skills_frequency",
    "agg_market_overview": "(SELECT area_code, count(*) AS total_jobs FROM fact "
    "WHERE posted_date >= DATE '2001-08-01' - 30 GROUP BY area_code, seniority_code)",
}
REPORTED = [
    "stg_jobs", "stg_companies", "stg_locations", "int_jobs_with_skills", "int_jobs_classified",
    "int_company_size", "dim_company", "dim_location", "fact_job_posting", "agg_skills_frequency",
    "dim_area", "dim_seniority", "agg_market_overview",
]


def report_sql() -> str:
    parts = []
    for name in REPORTED:
        source, declared = SQL_NAMES.get(name, name), checks.CHECKS[name]

        def row(check, column, count):
            parts.append(f"SELECT '{name}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
                         f"({count}) AS violations")

        for c in declared.get("required", []):
            row("not_null", c, f"SELECT count(*) FROM {source} WHERE {c} IS NULL")
        for c in declared.get("keys", []):
            row("unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL "
                             f"GROUP BY {c} HAVING count(*) > 1)")
        for c, values in declared.get("accepted", {}).items():
            listed = ", ".join(f"'{v}'" for v in values)
            row("accepted_values", c, f"SELECT count(*) FROM {source} WHERE {c} NOT IN ({listed})")
        for c, parent in declared.get("parents", {}).items():
            row("relationships", c, f"SELECT count(*) FROM {source} f WHERE {c} IS NOT NULL AND NOT EXISTS "
                                    f"(SELECT 1 FROM {parent} p WHERE p.{c} = f.{c})")
    return " UNION ALL ".join(parts)


@query("quality_report", S.on_gold(report_sql()))
def quality_report(spark, folder):
    return checks.report(S.gold(spark, folder), REPORTED)


@query("quality_report_stored", S.on_gold(report_sql()))
def quality_report_stored(spark, folder):
    """The same over written models, each built once from those before it."""
    keep = stored_in(shared_folder(spark, "gold"))
    return checks.report(G.build_gold(spark, S.silver(spark, folder), S.JOBS_AS_OF, keep), REPORTED)


DIM_SKILL_SQL = """
  , named AS (SELECT DISTINCT skill AS skill_name FROM int_jobs_with_skills WHERE skill <> ''),
  dim AS (
    SELECT md5(skill_name) AS skill_id, skill_name, CASE
      {branches}
      ELSE 'cross_area' END AS primary_category FROM named)
  SELECT 'dim_skill' AS table_name, check_name, column_name, violations FROM (
    SELECT 'not_null' AS check_name, 'skill_id' AS column_name, count(*) FILTER (skill_id IS NULL) AS violations FROM dim
    UNION ALL SELECT 'not_null', 'skill_name', count(*) FILTER (skill_name IS NULL) FROM dim
    UNION ALL SELECT 'not_null', 'primary_category', count(*) FILTER (primary_category IS NULL) FROM dim
    UNION ALL SELECT 'accepted_values', 'primary_category', count(*) FILTER (primary_category NOT IN
      ('data_engineering', 'data_science', 'analytics_bi', 'ml_mlops', 'cross_area')) FROM dim
    UNION ALL SELECT 'unique', 'skill_id', count(*) FROM (SELECT skill_id FROM dim GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique', 'skill_name', count(*) FROM (SELECT skill_name FROM dim GROUP BY 1 HAVING count(*) > 1))"""
DIM_SKILL_SQL = DIM_SKILL_SQL.replace("{branches}", "\n      ".join(
    f"WHEN lower(skill_name) IN ({', '.join(S.sql_text(t.lower()) for t in terms)}) THEN '{category}'"
    for category, terms in V.SKILL_CATEGORIES.items()
))


@query("quality_dim_skill", S.on_gold(DIM_SKILL_SQL))
def quality_dim_skill(spark, folder):
    return checks.report(S.gold(spark, folder), ["dim_skill"])


@query("rejected_areas", S.on_staged("""
  SELECT job_id, job_area FROM stg_jobs
  WHERE job_area NOT IN ('data_engineering', 'data_science', 'data_analytics', 'ml_mlops', 'bi', 'unknown')"""))
def rejected_areas(spark, folder):
    """Rows behind a violated check: the staging areas outside the accepted set."""
    staged = S.gold(spark, folder)["stg_jobs"]
    values = checks.CHECKS["stg_jobs"]["accepted"]["job_area"]
    return Q.accepted_values(staged, "job_area", values).select("job_id", "job_area")


@query("repeated_values", """
  SELECT o_custkey, count(*) AS occurrences FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def repeated_values(spark, folder):
    return Q.unique(table(spark, folder, "orders"), "o_custkey")


@query("broken_references", """
  SELECT o_orderkey, o_custkey FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def broken_references(spark, folder):
    parent = table(spark, folder, "customer").filter("c_acctbal >= 0")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return Q.relationships(rows, "o_custkey", parent, "c_custkey").select("o_orderkey", "o_custkey")


@query("orphan_report", S.on_gold("""
  , f AS (SELECT job_id, company_id, CASE WHEN is_remote THEN NULL ELSE location_id END AS location_id FROM fact)
  SELECT 'orphan_company' AS check_type, job_id, company_id AS orphan_id FROM f
  WHERE company_id NOT IN (SELECT company_id FROM dim_company WHERE company_name <> 'Empresa nao informada')
  UNION ALL
  SELECT 'orphan_location', job_id, location_id FROM f
  WHERE location_id IS NULL OR location_id NOT IN (SELECT location_id FROM dim_location WHERE location_name <> 'Nao informado')"""))
def orphan_report(spark, folder):
    """Nameless companies and locations are taken away; remote jobs lose their location."""
    models = S.gold(spark, folder)
    fact = models["fact_job_posting"].withColumn("location_id", F.when(~F.col("is_remote"), F.col("location_id")))
    return checks.fact_orphans({
        "fact_job_posting": fact,
        "dim_company": models["dim_company"].filter("company_name <> 'Empresa nao informada'"),
        "dim_location": models["dim_location"].filter("location_name <> 'Nao informado'"),
    })


@query("freshness", """
  SELECT event_type, strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen,
    CASE WHEN age > 48 THEN 'error' WHEN age > 25 THEN 'warn' ELSE 'pass' END AS status
  FROM (
    SELECT 'all' AS event_type, max(ts) AS last_seen,
      (epoch_us(TIMESTAMP '2024-02-01 01:00:00') - epoch_us(max(ts))) / 3.6e9 AS age FROM events
    UNION ALL
    SELECT 'early', max(ts), (epoch_us(TIMESTAMP '2024-02-01 01:00:00') - epoch_us(max(ts))) / 3.6e9
    FROM events WHERE value > 60)""")
def freshness(spark, folder):
    """Age of the newest event, and of the newest large one."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def aged(name, rows):
        return Q.freshness(rows, "ts", "2024-02-01 01:00:00").select(
            F.lit(name).alias("event_type"),
            F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "status",
        )

    return aged("all", events).unionByName(aged("early", events.filter("value > 60")))


@query("required_sources", """
  SELECT v.source FROM (VALUES ('view'), ('click'), ('signup'), ('newsletter')) AS v(source)
  WHERE v.source NOT IN (SELECT event_type FROM events)""")
def required_sources(spark, folder):
    landed = table(spark, folder, "events").select(F.col("event_type").alias("source"))
    return Q.missing_sources(
        landed, required=["view", "click", "signup", "newsletter", "optional"], skipped=["optional"]
    )
