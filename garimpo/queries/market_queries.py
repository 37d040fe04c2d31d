"""Search and market reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import market as K
from . import stand_ins as S
from .registry import query

SENIORITY_LABEL = """CASE f.seniority_code WHEN 'estagio' THEN 'Estágio' WHEN 'junior' THEN 'Júnior'
  WHEN 'pleno' THEN 'Pleno' WHEN 'senior' THEN 'Sênior' WHEN 'especialista' THEN 'Especialista'
  WHEN 'lead' THEN 'Lead' ELSE 'Não Informado' END"""

SEARCH = f""", found AS (
  SELECT f.job_id, f.job_title AS title, c.company_name AS company, l.location_name AS location,
    a.area_label AS area, s.order_rank AS seniority_rank, {SENIORITY_LABEL} AS seniority,
    j.skills AS skills, f.job_url AS url, f.posted_date AS posted_at, f.is_remote, f.is_hybrid
  FROM fact f JOIN dim_company c ON f.company_id = c.company_id
    JOIN dim_location l ON f.location_id = l.location_id
    JOIN dim_area a ON f.area_code = a.area_code
    JOIN dim_seniority s ON f.seniority_code = s.seniority_code
    LEFT JOIN jobs j ON f.job_id = j.job_id
  WHERE {{where}} ORDER BY f.posted_date DESC NULLS FIRST, f.job_id LIMIT 201)"""

FILTERED = SEARCH.format(where="""f.area_code IN ('data_engineering', 'data_science', 'bi')
    AND f.seniority_code IN ('lead', 'senior', 'unknown')
    AND (l.location_name IN ('NATION_3, EUROPE') OR l.country_name IN ('Brasil', 'Estados Unidos'))
    AND (f.is_remote OR (NOT f.is_remote AND NOT f.is_hybrid))
    AND f.posted_date >= DATE '2001-08-01' - 900
    AND (lower(f.job_title) LIKE '%mo_ile%' OR lower(c.company_name) LIKE '%mo_ile%')
    AND list_has_all(j.skills, ['red', 'bolt'])""")
EVERYTHING = SEARCH.format(where="TRUE")

FOUND = """job_id, title, company, location, area, seniority_rank, seniority,
  array_to_string(skills, '|') AS skills, url, posted_at, is_remote, is_hybrid"""


def searched(spark, folder, **filters):
    silver = S.silver(spark, folder)
    return K.search(S.gold(spark, folder), silver["jobs"], S.JOBS_AS_OF, **filters)


@query("search_postings", S.on_gold(FILTERED + f"SELECT {FOUND} FROM found"))
def search_postings(spark, folder):
    found = searched(
        spark, folder, areas=["data_engineering", "data_science", "bi"],
        seniorities=["lead", "senior", "unknown"],
        locations=["NATION_3, EUROPE", "Brasil", "Estados Unidos"],
        modes=["remote", "onsite"], skills=["red", "bolt"], days=900, term="MO_ile",
    )
    return found.withColumn("skills", F.array_join("skills", "|"))


@query("search_all", S.on_gold(EVERYTHING + f"SELECT {FOUND} FROM found"))
def search_all(spark, folder):
    """No filter: the newest 201 postings."""
    return searched(spark, folder).withColumn("skills", F.array_join("skills", "|"))


@query("search_overflow", S.on_gold(EVERYTHING + """
  SELECT CAST(least(count(*), 200) AS BIGINT) AS shown, count(*) > 200 AS overflow,
    CASE WHEN count(*) > 200 THEN '200+' ELSE CAST(count(*) AS VARCHAR) END AS label FROM found"""))
def search_overflow(spark, folder):
    return K.with_overflow(searched(spark, folder))[1]


@query("search_cards", S.on_gold(EVERYTHING + """
  SELECT job_id, title, company, location, area, seniority, url,
    CASE WHEN is_remote THEN 'Remoto' WHEN is_hybrid THEN 'Hibrido' ELSE 'Presencial' END AS mode_tag,
    CASE WHEN len(skills) > 0 THEN array_to_string(skills, ', ') ELSE 'Nao mapeada' END AS skills_text,
    coalesce(strftime(posted_at, '%d/%m'), '') AS posted_text
  FROM found ORDER BY posted_at DESC NULLS FIRST, job_id LIMIT 200"""))
def search_cards(spark, folder):
    return K.cards(K.with_overflow(searched(spark, folder))[0])


@query("filter_options", S.on_gold("""
  , used AS (SELECT * FROM dim_location WHERE location_id IN (SELECT location_id FROM fact))
  SELECT 'location' AS kind, name, 0 AS position FROM (
    SELECT location_name AS name FROM used WHERE location_name <> 'desconhecido'
    UNION SELECT country_name FROM used)
  UNION ALL SELECT 'skill', skill, 0 FROM (SELECT DISTINCT skill FROM int_jobs_with_skills)
  UNION ALL SELECT 'area', area_label, 0 FROM dim_area
  UNION ALL SELECT 'seniority', seniority_code, order_rank FROM dim_seniority"""))
def filter_options(spark, folder):
    g = S.gold(spark, folder)

    def as_option(kind, df, name, position=F.lit(0)):
        return df.select(F.lit(kind).alias("kind"), F.col(name).alias("name"), position.alias("position"))

    return (
        as_option("location", K.location_options(g), "name")
        .unionByName(as_option("skill", K.skill_options(g), "skill_name"))
        .unionByName(as_option("area", K.area_options(g), "area_label"))
        .unionByName(as_option("seniority", K.seniority_options(g), "seniority_code", F.col("order_rank")))
    )


@query("kpis", S.on_gold("""
  SELECT count(*) AS total_jobs,
    CAST(round(CAST(100.0 * count(*) FILTER (is_remote) AS DOUBLE) / nullif(count(*), 0), 1) AS DOUBLE) AS pct_remote,
    CAST(round(CAST(100.0 * count(*) FILTER (is_hybrid) AS DOUBLE) / nullif(count(*), 0), 1) AS DOUBLE) AS pct_hybrid,
    count(*) FILTER (posted_date >= DATE '2001-08-01' - 1) AS jobs_today
  FROM fact"""))
def kpis(spark, folder):
    row = K.kpis(S.gold(spark, folder)["fact_job_posting"], S.JOBS_AS_OF)
    return row.withColumns({c: F.col(c).cast("double") for c in ("pct_remote", "pct_hybrid")})


@query("dist_area", S.on_gold("""
  SELECT area_label AS area, count(f.job_id) AS jobs
  FROM fact f JOIN dim_area a ON f.area_code = a.area_code GROUP BY area_label"""))
def dist_area(spark, folder):
    return K.by_area(S.gold(spark, folder))


@query("dist_seniority", S.on_gold(f"""
  SELECT {SENIORITY_LABEL} AS seniority, s.order_rank, count(f.job_id) AS jobs
  FROM fact f JOIN dim_seniority s ON f.seniority_code = s.seniority_code
  GROUP BY f.seniority_code, s.order_rank"""))
def dist_seniority(spark, folder):
    return K.by_seniority(S.gold(spark, folder))


@query("mode_by_area", S.on_gold("""
  SELECT area_label AS area, count(*) FILTER (is_remote) AS remote, count(*) FILTER (is_hybrid) AS hybrid,
    count(*) FILTER (NOT is_remote AND NOT is_hybrid) AS onsite
  FROM fact f JOIN dim_area a ON f.area_code = a.area_code GROUP BY area_label"""))
def mode_by_area(spark, folder):
    return K.modes_by_area(S.gold(spark, folder))


@query("top_skills", S.on_gold("""
  SELECT skill, CAST(sum(job_count) AS BIGINT) AS frequency FROM skills_frequency GROUP BY skill
  ORDER BY frequency DESC, skill LIMIT 15"""))
def top_skills(spark, folder):
    return K.top_skills(S.gold(spark, folder)["agg_skills_frequency"])


@query("top_skills_of_area", S.on_gold("""
  SELECT skill, CAST(sum(job_count) AS BIGINT) AS frequency FROM skills_frequency
  WHERE job_area = 'data_science' GROUP BY skill ORDER BY frequency DESC, skill LIMIT 5"""))
def top_skills_of_area(spark, folder):
    return K.top_skills(S.gold(spark, folder)["agg_skills_frequency"], "data_science", 5)


@query("skills_heatmap", S.on_gold("""
  , best AS (SELECT skill FROM skills_frequency GROUP BY skill ORDER BY sum(job_count) DESC, skill LIMIT 10)
  SELECT s.skill, a.area_label AS area, CAST(sum(job_count) AS BIGINT) AS frequency
  FROM skills_frequency s JOIN dim_area a ON s.job_area = a.area_code
  WHERE s.skill IN (SELECT skill FROM best) GROUP BY s.skill, a.area_label"""))
def skills_heatmap(spark, folder):
    return K.skills_heatmap(S.gold(spark, folder))


@query("digest", S.on_gold("""
  SELECT f.job_title AS title, c.company_name AS company, l.location_name AS location, a.area_label AS area,
    CASE WHEN f.is_remote THEN 'Remoto 🌐' WHEN f.is_hybrid THEN 'Híbrido 🏢' ELSE 'Presencial 🏢' END AS mode,
    f.job_url AS url
  FROM fact f JOIN dim_company c ON f.company_id = c.company_id
    JOIN dim_location l ON f.location_id = l.location_id JOIN dim_area a ON f.area_code = a.area_code
  WHERE f.posted_date = DATE '2001-07-31' ORDER BY f.job_id LIMIT 10"""))
def digest(spark, folder):
    return K.digest(S.gold(spark, folder), "2001-07-31")
