"""Staging, star schema and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import country_code, country_name
from ..operators import merge as M
from ..plans import gold as G
from ..plans import rolling as W
from ..session import shared_folder
from ..sources import daily as D
from . import stand_ins as S
from .registry import REGISTRY, query, texts


def joined(column: str):
    return F.array_join(column, "|")


@query("stg_jobs", S.on_staged("""
  SELECT job_id, job_sk, company_id, location_id, job_title, job_area, job_seniority,
    array_to_string(skills_array, '|') AS skills, job_url, posted_date, is_remote, is_hybrid, is_active
  FROM stg_jobs"""))
def stg_jobs(spark, folder):
    return G.stg_jobs(S.jobs(spark, folder)).withColumn("skills", joined("skills_array")).drop(
        "skills_array", "source_ids", "ingested_at"
    )


@query("stg_companies", S.on_staged("SELECT company_id, company_name FROM stg_companies"))
def stg_companies(spark, folder):
    return G.stg_companies(S.companies(spark, folder))


@query("stg_locations", S.on_staged(
    "SELECT location_id, location_name, country, is_remote FROM stg_locations"))
def stg_locations(spark, folder):
    return G.stg_locations(S.locations(spark, folder)).drop("city", "state")


@query("classified_fallback", S.on_staged("""
  SELECT job_id, area, seniority, has_skills, is_active, posted_date FROM int_jobs_classified"""))
def classified_fallback(spark, folder):
    return G.int_jobs_classified(G.stg_jobs(S.jobs(spark, folder))).select(
        "job_id", "area", "seniority", "has_skills", "is_active", "posted_date"
    )


@query("explode_skills", S.on_staged(
    "SELECT job_id, company_id, job_area, posted_date, is_remote, skill FROM int_jobs_with_skills"))
def explode_skills(spark, folder):
    return G.int_jobs_with_skills(G.stg_jobs(S.jobs(spark, folder))).select(
        "job_id", "company_id", "job_area", "posted_date", "is_remote", "skill"
    )


@query("company_size", S.on_staged(
    "SELECT company_id, total_postings_30d, company_size FROM int_company_size"))
def company_size(spark, folder):
    return G.int_company_size(G.stg_jobs(S.jobs(spark, folder)), S.JOBS_AS_OF)


@query("dim_company", S.on_gold("SELECT * FROM dim_company"))
def dim_company(spark, folder):
    return S.gold(spark, folder)["dim_company"]


@query("dim_location", S.on_gold("SELECT * FROM dim_location"))
def dim_location(spark, folder):
    return S.gold(spark, folder)["dim_location"]


@query("dim_location_country", f"""
  SELECT doc_id, country_code, CASE country_code WHEN 'BR' THEN 'Brasil' WHEN 'US' THEN 'Estados Unidos'
      WHEN 'CA' THEN 'Canadá' WHEN 'CL' THEN 'Chile' WHEN 'GB' THEN 'Reino Unido'
      ELSE 'Global/Não Informado' END AS country_name
  FROM (SELECT doc_id, {S.sql_country("text")} AS country_code FROM documents)""")
def dim_location_country(spark, folder):
    coded = texts(spark, folder, "documents", "doc_id", "text").select("doc_id", country_code(F.col("text")).alias("country_code"))
    return coded.withColumn("country_name", country_name(F.col("country_code")))


@query("dim_skill", S.on_gold("""
  SELECT md5(skill) AS skill_id, skill AS skill_name, lower(skill) AS skill_canonical,
    'cross_area' AS primary_category
  FROM (SELECT DISTINCT skill FROM int_jobs_with_skills)"""))
def dim_skill(spark, folder):
    return S.gold(spark, folder)["dim_skill"]


@query("static_dims", S.on_gold("""
  SELECT 'area' AS dimension, a.area_code AS code, any_value(a.area_label) AS label,
    any_value(a.area_order) AS position, count(f.job_id) AS jobs
  FROM dim_area a LEFT JOIN fact f ON f.area_code = a.area_code GROUP BY a.area_code
  UNION ALL
  SELECT 'seniority', s.seniority_code, any_value(s.seniority_label), any_value(s.order_rank),
    count(f.job_id)
  FROM dim_seniority s LEFT JOIN fact f ON f.seniority_code = s.seniority_code GROUP BY s.seniority_code"""))
def static_dims(spark, folder):
    """The static dimensions with the number of fact rows of each code."""
    g = S.gold(spark, folder)

    def used(name, dim, code, label, position):
        counts = g["fact_job_posting"].groupBy(code).agg(F.count(F.lit(1)).alias("jobs"))
        return dim.join(counts, code, "left").select(
            F.lit(name).alias("dimension"), F.col(code).alias("code"), F.col(label).alias("label"),
            F.col(position).alias("position"), F.coalesce("jobs", F.lit(0)).alias("jobs"),
        )

    return used("area", g["dim_area"], "area_code", "area_label", "area_order").unionByName(
        used("seniority", g["dim_seniority"], "seniority_code", "seniority_label", "order_rank")
    )


FACT = """job_id, company_id, location_id, area_code, seniority_code, job_title, job_url, posted_date,
  is_remote, is_hybrid, has_skills, array_to_string(source_ids, '|') AS source_ids"""


@query("fact_star", S.on_gold(f"SELECT {FACT} FROM fact"))
def fact_star(spark, folder):
    fact = S.gold(spark, folder)["fact_job_posting"]
    return fact.withColumn("source_ids", joined("source_ids")).drop("ingested_at")


@query("incremental_fact", S.on_gold("""
  , mark AS (SELECT max(ingested_at) AS m FROM fact WHERE posted_date < DATE '2001-07-01')
  SELECT job_id, area_code, seniority_code, posted_date FROM fact
  WHERE posted_date < DATE '2001-07-01' OR ingested_at > (SELECT m FROM mark)"""))
def incremental_fact(spark, folder):
    """The fact of the postings before July, then everything ingested above its mark."""
    rows = S.gold(spark, folder)["fact_job_posting"]
    loaded = rows.filter(F.col("posted_date") < F.lit("2001-07-01").cast("date"))
    return G.load_fact(loaded, rows).select("job_id", "area_code", "seniority_code", "posted_date")


@query("incremental_fact_by_day", S.on_gold("""
  , mark AS (SELECT max(ingested_at) AS m FROM fact WHERE posted_date < DATE '2001-07-01')
  SELECT job_id, area_code, seniority_code, posted_date FROM fact
  WHERE posted_date < DATE '2001-07-01' OR ingested_at > (SELECT m FROM mark)"""))
def incremental_fact_by_day(spark, folder):
    """The same load into a table partitioned by load time, twice: the second run finds nothing."""
    rows = S.gold(spark, folder)["fact_job_posting"]
    path = shared_folder(spark, "fact-by-day")
    D.write_days(rows.filter(F.col("posted_date") < F.lit("2001-07-01").cast("date")), path, "ingested_at", "year")
    D.load_days(rows, path, "job_id", "ingested_at", "year")
    D.load_days(rows, path, "job_id", "ingested_at", "year")
    return D.read_days(spark, path).select("job_id", "area_code", "seniority_code", "posted_date")


@query("fact_schema_change", S.on_gold("""
  , held AS (SELECT count(*) AS n FROM fact WHERE posted_date < DATE '2001-07-01'),
  mark AS (SELECT max(ingested_at) AS m FROM fact WHERE posted_date < DATE '2001-07-01'),
  later AS (SELECT count(*) AS n FROM fact WHERE ingested_at > (SELECT m FROM mark))
  SELECT change, change <> 'none' AS refused, held.n + CASE WHEN change = 'none' THEN later.n ELSE 0 END AS rows
  FROM held, later, (VALUES ('added column'), ('dropped column'), ('other order'), ('other type'), ('none')) AS c(change)"""))
def fact_schema_change(spark, folder):
    """Loads whose columns or types changed are refused and leave the table as it was."""
    rows = S.gold(spark, folder)["fact_job_posting"]
    path = shared_folder(spark, "fact-by-day")
    D.write_days(rows.filter(F.col("posted_date") < F.lit("2001-07-01").cast("date")), path, "ingested_at", "year")
    changes = {
        "added column": rows.withColumn("salary", F.lit(None).cast("double")),
        "dropped column": rows.drop("job_url"),
        "other order": rows.select(*reversed(rows.columns)),
        "other type": rows.withColumn("posted_date", F.col("posted_date").cast("string")),
        "none": rows,
    }
    parts = []
    for change, arriving in changes.items():
        try:
            D.load_days(arriving, path, "job_id", "ingested_at", "year")
            refused = False
        except ValueError:
            refused = True
        held = D.read_days(spark, path).agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
        parts.append((change, refused, held))
    return spark.createDataFrame(parts, "change string, refused boolean, rows long")


@query("market_overview", S.on_gold("""
  SELECT area_code, seniority_code, count(*) AS total_jobs,
    CAST(round(CAST(100.0 * count(*) FILTER (is_remote) AS DOUBLE) / count(*), 1) AS DOUBLE) AS pct_remote,
    DATE '2001-08-01' AS reference_date
  FROM fact WHERE posted_date >= DATE '2001-08-01' - 30 GROUP BY area_code, seniority_code"""))
def market_overview(spark, folder):
    overview = S.gold(spark, folder)["agg_market_overview"]
    return overview.withColumn("pct_remote", F.col("pct_remote").cast("double"))


@query("skills_frequency", S.on_gold("SELECT * FROM skills_frequency"))
def skills_frequency(spark, folder):
    return S.gold(spark, folder)["agg_skills_frequency"]


AREA_SKILLS = """, counts AS (
  SELECT s.job_area, s.skill, count(DISTINCT s.job_id) AS skill_count
  FROM int_jobs_with_skills s JOIN fact f ON s.job_id = f.job_id
  WHERE f.posted_date >= DATE '2001-08-01' - 30 GROUP BY s.job_area, s.skill)"""


@query("area_skill_counts", S.on_gold(AREA_SKILLS + "SELECT * FROM counts"))
def area_skill_counts(spark, folder):
    g = S.gold(spark, folder)
    return G.area_skill_counts(G.job_skills(g["stg_jobs"]), g["fact_job_posting"], S.JOBS_AS_OF)


@query("top_skills_per_area", S.on_gold(AREA_SKILLS + """
  SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY job_area ORDER BY skill_count DESC) AS INTEGER)
    AS skill_rank FROM counts) WHERE skill_rank <= 10"""))
def top_skills_per_area(spark, folder):
    g = S.gold(spark, folder)
    return G.top_skills_per_area(G.job_skills(g["stg_jobs"]), g["fact_job_posting"], S.JOBS_AS_OF)


@query("fact_rebuild", S.on_gold("""
  SELECT area_code, count(*) AS jobs, count(job_url) AS with_url FROM fact GROUP BY area_code"""))
def fact_rebuild(spark, folder):
    """A full rebuild replaces whatever the target holds."""
    rows = S.gold(spark, folder)["fact_job_posting"]
    old = rows.filter(F.col("area_code") == "bi")
    rebuilt = M.incremental(old, rows, "job_id", "ingested_at", mode="full")
    return rebuilt.groupBy("area_code").agg(
        F.count(F.lit(1)).alias("jobs"), F.count("job_url").alias("with_url")
    )


# --- rolling windows from daily partials ------------------------------------------
def partials(spark, folder, name, rows, days):
    """Partials of the postings before 2001-07-15, then those of the later days; the last ``days`` days of them."""
    path = shared_folder(spark, f"days-{name}")
    W.refresh(rows.filter("posted_date < date'2001-07-15'"), name, path, unit="year")
    W.refresh(rows, name, path, "2001-07-15", unit="year")
    return W.window(spark, path, days, S.JOBS_AS_OF, unit="year")


@query("market_overview_rolling", REGISTRY["market_overview"].sql)
def market_overview_rolling(spark, folder):
    """``market_overview`` as a sum of stored days."""
    days = partials(spark, folder, "overview", S.gold(spark, folder)["fact_job_posting"], 30)
    return W.market_overview(days, S.JOBS_AS_OF).withColumn("pct_remote", F.col("pct_remote").cast("double"))


@query("skills_frequency_rolling", REGISTRY["skills_frequency"].sql)
def skills_frequency_rolling(spark, folder):
    rows = G.job_skills(S.gold(spark, folder)["stg_jobs"])
    return W.skills_frequency(partials(spark, folder, "skills", rows, 90), S.JOBS_AS_OF)


@query("company_size_rolling", REGISTRY["company_size"].sql)
def company_size_rolling(spark, folder):
    return W.company_sizes(partials(spark, folder, "companies", S.gold(spark, folder)["stg_jobs"], 30))
