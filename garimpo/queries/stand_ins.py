"""Silver tables derived from the test tables, in Spark and as SQL.

Orders stand in for jobs, customers for companies, nations for locations, the
words of the ordered parts' names for skills, event days for pipeline runs and
web pages for scraped postings.  Every definition reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans import gold as G
from .registry import table, texts

JOBS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"
RUN_AT = "2024-02-01 00:00:00"


# --- jobs, companies, locations -----------------------------------------------
def order_skills(spark: SparkSession, folder: str) -> DataFrame:
    """(o_orderkey, skills): distinct words of the order's part names, sorted."""
    words = table(spark, folder, "part").select(
        "p_partkey", F.explode(F.split("p_name", " ")).alias("word")
    )
    return (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey")
        .join(words, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("word")).alias("skills"))
        .withColumnRenamed("l_orderkey", "o_orderkey")
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    segment, priority, price = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_totalprice")
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("date")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"
    )
    return (
        table(spark, folder, "orders")
        .join(customers, "o_custkey", "left")
        .join(order_skills(spark, folder), "o_orderkey", "left")
        .select(
            F.col("o_orderkey").cast("string").alias("job_id"),
            F.array(F.col("o_orderkey").cast("string"), F.concat(F.lit("C"), F.col("o_custkey"))).alias("source_ids"),
            F.sha2(F.col("o_orderkey").cast("string"), 256).alias("dedup_hash"),
            F.when(~((priority == "4-NOT SPECIFIED") & (status == "P")),
                   F.concat_ws(" ", segment, F.substring(priority, 3, 20))).alias("title"),
            F.col("o_custkey").cast("string").alias("company_id"),
            F.col("c_nationkey").cast("string").alias("location_id"),
            F.when(segment == "AUTOMOBILE", "data_engineering")
            .when(segment == "BUILDING", "data_science")
            .when((segment == "FURNITURE") & (status == "P"), "")
            .when(segment == "FURNITURE", "bi")
            .when(segment == "HOUSEHOLD", "non_tech").alias("area"),
            F.when(priority == "1-URGENT", "lead").when(priority == "2-HIGH", "senior")
            .when(priority == "3-MEDIUM", "pleno").when(priority == "5-LOW", " ").alias("seniority"),
            "skills",
            F.when(status == "O", F.concat(F.lit("https://jobs.example.com/"), F.col("o_orderkey"))).alias("url"),
            F.when(~((priority == "5-LOW") & (status == "F")), day).alias("posted_at"),
            F.when(price >= 50000, price > 350000).alias("is_remote"),
            price.between(250000, 350000).alias("is_hybrid"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.when(status == "F", price > 100000).when(status == "O", True).alias("is_active"),
            F.when(priority == "4-NOT SPECIFIED", "unknown").otherwise("syntax").alias("classification_source"),
        )
    )


def companies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    place = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    region = F.col("r_name")
    return place.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.when(~F.col("n_name").endswith("0"), F.concat_ws(", ", "n_name", "r_name")).alias("raw"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.when(region == "AMERICA", "US").alias("country"),
        F.when(region == "ASIA", True).alias("is_remote"),
    )


def silver(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "jobs": jobs(spark, folder),
        "companies": companies(spark, folder),
        "locations": locations(spark, folder),
    }


def gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The gold plans of a folder; plans are built once per session, data is not kept."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _PLANS:
        _PLANS[key] = G.build_gold(spark, silver(spark, folder), JOBS_AS_OF)
    return _PLANS[key]


_PLANS: dict[tuple[str, str], dict[str, DataFrame]] = {}


JOBS_SQL = """
words AS (
  SELECT DISTINCT l_orderkey, unnest(string_split(p_name, ' ')) AS word
  FROM lineitem JOIN part ON l_partkey = p_partkey),
order_skills AS (
  SELECT l_orderkey, list_sort(list(word)) AS skills FROM words GROUP BY l_orderkey),
jobs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id,
    [CAST(o_orderkey AS VARCHAR), 'C' || o_custkey] AS source_ids,
    CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P')
         THEN c_mktsegment || ' ' || substr(o_orderpriority, 3) END AS title,
    CAST(o_custkey AS VARCHAR) AS company_id, CAST(c_nationkey AS VARCHAR) AS location_id,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'data_engineering'
         WHEN c_mktsegment = 'BUILDING' THEN 'data_science'
         WHEN c_mktsegment = 'FURNITURE' AND o_orderstatus = 'P' THEN ''
         WHEN c_mktsegment = 'FURNITURE' THEN 'bi'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'non_tech' END AS area,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'lead' WHEN '2-HIGH' THEN 'senior'
         WHEN '3-MEDIUM' THEN 'pleno' WHEN '5-LOW' THEN ' ' END AS seniority,
    skills,
    CASE WHEN o_orderstatus = 'O' THEN 'https://jobs.example.com/' || o_orderkey END AS url,
    CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
         THEN CAST(o_orderdate AS DATE) END AS posted_at,
    CASE WHEN o_totalprice >= 50000 THEN o_totalprice > 350000 END AS is_remote,
    o_totalprice BETWEEN 250000 AND 350000 AS is_hybrid,
    o_orderdate AS created_at,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 100000
         WHEN o_orderstatus = 'O' THEN TRUE END AS is_active,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE 'syntax' END
      AS classification_source
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN order_skills ON o_orderkey = l_orderkey),
companies AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name
  FROM customer),
locations AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id,
    CASE WHEN NOT n_name LIKE '%0' THEN n_name || ', ' || r_name END AS raw,
    CASE WHEN r_name = 'AMERICA' THEN 'US' END AS country,
    CASE WHEN r_name = 'ASIA' THEN TRUE END AS is_remote
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

STAGED_SQL = JOBS_SQL + """,
stg_jobs AS (
  SELECT job_id, md5(job_id) AS job_sk, company_id, location_id, title AS job_title, area AS job_area,
    seniority AS job_seniority, skills AS skills_array, url AS job_url, posted_at AS posted_date,
    coalesce(is_remote, FALSE) AS is_remote, coalesce(is_hybrid, FALSE) AS is_hybrid,
    coalesce(is_active, TRUE) AS is_active, source_ids, created_at AS ingested_at
  FROM jobs WHERE title IS NOT NULL),
stg_companies AS (
  SELECT id AS company_id, coalesce(name, 'Empresa nao informada') AS company_name FROM companies),
stg_locations AS (
  SELECT id AS location_id, coalesce(raw, 'Nao informado') AS location_name,
    coalesce(country, 'BR') AS country, coalesce(is_remote, FALSE) AS is_remote FROM locations),
int_jobs_classified AS (
  SELECT * FROM (
    SELECT job_id, job_sk, company_id, location_id, job_title, job_url, posted_date, is_remote,
      is_hybrid, is_active, source_ids, ingested_at,
      coalesce(nullif(trim(job_area), ''), 'unknown') AS area,
      coalesce(nullif(trim(job_seniority), ''), 'unknown') AS seniority,
      coalesce(len(skills_array) > 0, FALSE) AS has_skills
    FROM stg_jobs)
  WHERE area NOT IN ('non_tech', 'non_data') AND is_active),
int_jobs_with_skills AS (
  SELECT job_id, company_id, location_id, job_area, job_seniority, posted_date, is_remote,
    is_hybrid, trim(skill) AS skill
  FROM (SELECT *, unnest(skills_array) AS skill FROM stg_jobs)
  WHERE trim(skill) <> ''),
int_company_size AS (
  SELECT company_id, count(*) AS total_postings_30d,
    CASE WHEN count(*) >= 10 THEN 'grande' WHEN count(*) >= 3 THEN 'media' ELSE 'pequena' END
      AS company_size
  FROM stg_jobs WHERE posted_date >= DATE '2001-08-01' - 30 GROUP BY company_id)"""

GOLD_SQL = STAGED_SQL + """,
dim_area AS (
  SELECT * FROM (VALUES ('data_engineering', 'Engenharia de Dados', 1),
    ('data_science', 'Ciencia de Dados', 2), ('data_analytics', 'Analise de Dados', 3),
    ('ml_mlops', 'Machine Learning / MLOps', 4), ('bi', 'Business Intelligence', 5),
    ('unknown', 'Nao Classificado', 6)) AS t(area_code, area_label, area_order)),
dim_seniority AS (
  SELECT * FROM (VALUES ('estagio', 'Estagiario', 1), ('junior', 'Junior', 2), ('pleno', 'Pleno', 3),
    ('senior', 'Senior', 4), ('especialista', 'Especialista', 5), ('lead', 'Lead / Staff', 6),
    ('unknown', 'Nao Informado', 7)) AS t(seniority_code, seniority_label, order_rank)),
dim_company AS (
  SELECT c.company_id, c.company_name, coalesce(s.company_size, 'pequena') AS company_size,
    coalesce(s.total_postings_30d, 0) AS postings_last_30d
  FROM stg_companies c LEFT JOIN int_company_size s ON c.company_id = s.company_id),
fact AS (
  SELECT j.job_id, j.company_id, j.location_id, a.area_code, s.seniority_code, j.job_title,
    j.job_url, j.posted_date, j.is_remote, j.is_hybrid, j.has_skills, j.source_ids, j.ingested_at
  FROM int_jobs_classified j LEFT JOIN dim_area a ON j.area = a.area_code
       LEFT JOIN dim_seniority s ON j.seniority = s.seniority_code),
dim_location AS (
  SELECT *, CASE country_code WHEN 'BR' THEN 'Brasil' WHEN 'US' THEN 'Estados Unidos'
      WHEN 'CA' THEN 'Canadá' WHEN 'CL' THEN 'Chile' WHEN 'GB' THEN 'Reino Unido'
      ELSE 'Global/Não Informado' END AS country_name
  FROM (SELECT location_id, location_name, is_remote, {country} AS country_code
        FROM stg_locations)),
skills_frequency AS (
  SELECT skill, job_area, posted_date AS reference_date, count(DISTINCT job_id) AS job_count,
    DATE '2001-08-01' AS snapshot_date
  FROM int_jobs_with_skills WHERE posted_date >= DATE '2001-08-01' - 90
  GROUP BY skill, job_area, posted_date)"""


def sql_country(name: str) -> str:
    """The country cascade over a name expression."""
    from ..functions import fixed_values as V

    cases = " ".join(
        "WHEN " + " OR ".join(f"lower({name}) LIKE '%{t}%'" for t in terms) + f" THEN '{code}'"
        for code, terms in V.COUNTRY_TERMS.items()
    )
    return f"CASE {cases} ELSE '{V.DEFAULT_COUNTRY}' END"


GOLD_SQL = GOLD_SQL.replace("{country}", sql_country("location_name"))


def on_jobs(select: str) -> str:
    return f"WITH {JOBS_SQL} {select}"


def on_staged(select: str) -> str:
    return f"WITH {STAGED_SQL} {select}"


def on_gold(select: str) -> str:
    return f"WITH {GOLD_SQL} {select}"


# --- run log --------------------------------------------------------------------
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run per event day; event types stand in for the sources."""
    kind, day = F.col("event_type"), F.col("ts").cast("date")
    stamp = F.col("ts").cast("timestamp")
    return (
        table(spark, folder, "events")
        .groupBy(day.alias("execution_date"))
        .agg(
            F.min(stamp).alias("started_at"),
            F.max(stamp).alias("_last"),
            F.count_if(kind == "view").cast("int").alias("adzuna_count"),
            F.count_if(kind == "click").cast("int").alias("jooble_count"),
            F.count_if(kind == "signup").cast("int").alias("remoteok_count"),
            F.count_if(kind == "purchase").cast("int").alias("gupy_count"),
            F.count(F.lit(1)).cast("int").alias("raw_inserted"),
            F.count_if(F.col("value") >= 10).cast("int").alias("dedup_new"),
            F.count_if(F.col("value") < 10).cast("int").alias("dedup_duplicates"),
            F.count_if(F.col("value") >= 20).cast("int").alias("classified_count"),
            F.count_if(kind == "error").alias("_errors"),
        )
        .select(
            "execution_date", "started_at",
            F.when(F.dayofweek("execution_date") != 1, F.col("_last")).alias("ended_at"),
            F.when(F.dayofweek("execution_date") == 1, "RUNNING")
            .when(F.col("_errors") * 5 > F.col("raw_inserted"), "FAILED")
            .otherwise("SUCCESS").alias("status"),
            "adzuna_count", "jooble_count", "remoteok_count", "gupy_count", "raw_inserted",
            "dedup_new", "dedup_duplicates", "classified_count",
            F.when(F.col("_errors") * 5 > F.col("raw_inserted"),
                   F.concat(F.col("_errors").cast("string"), F.lit(" errors"))).alias("error_message"),
        )
    )


RUN_LOG_SQL = """
run_log AS (
  SELECT execution_date, started_at,
    CASE WHEN dayofweek(execution_date) <> 0 THEN last_ts END AS ended_at,
    CASE WHEN dayofweek(execution_date) = 0 THEN 'RUNNING'
         WHEN errors * 5 > raw_inserted THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    adzuna_count, jooble_count, remoteok_count, gupy_count, raw_inserted, dedup_new,
    dedup_duplicates, classified_count,
    CASE WHEN errors * 5 > raw_inserted THEN errors || ' errors' END AS error_message
  FROM (
    SELECT CAST(ts AS DATE) AS execution_date, min(ts) AS started_at, max(ts) AS last_ts,
      CAST(count(*) FILTER (event_type = 'view') AS INTEGER) AS adzuna_count,
      CAST(count(*) FILTER (event_type = 'click') AS INTEGER) AS jooble_count,
      CAST(count(*) FILTER (event_type = 'signup') AS INTEGER) AS remoteok_count,
      CAST(count(*) FILTER (event_type = 'purchase') AS INTEGER) AS gupy_count,
      CAST(count(*) AS INTEGER) AS raw_inserted,
      CAST(count(*) FILTER (value >= 10) AS INTEGER) AS dedup_new,
      CAST(count(*) FILTER (value < 10) AS INTEGER) AS dedup_duplicates,
      CAST(count(*) FILTER (value >= 20) AS INTEGER) AS classified_count,
      count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY 1))"""


def on_runs(select: str) -> str:
    return f"WITH {RUN_LOG_SQL} {select}"


# --- postings from pages ----------------------------------------------------------
def page_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw postings: page title, path language as company, host as location, path number as day."""
    number = F.regexp_extract("url", r"/(\d+)", 1)
    return texts(spark, folder, "pages", "page_id", "url", "html").select(
        F.lpad(F.col("page_id").cast("string"), 12, "0").alias("id"),
        F.lit("gupy").alias("source"),
        F.col("page_id").cast("string").alias("source_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("url", "://[^/]+/([a-z]+)/", 1).alias("company"),
        F.regexp_extract("url", "://([^/]+)", 1).alias("location"),
        F.col("html").alias("description"),
        "url",
        F.when(number != "", F.date_add(F.lit("2024-01-01").cast("date"),
                                        F.floor(number.cast("bigint") / 100).cast("int"))).alias("posted_at"),
        F.lit(False).alias("is_remote"),
        F.lit(None).cast("string").alias("payload"),
        F.timestamp_seconds(F.lit(1706745600) + F.col("page_id")).alias("ingested_at"),
    )


PAGES_SQL = r"""
postings AS (
  SELECT lpad(CAST(page_id AS VARCHAR), 12, '0') AS id, CAST(page_id AS VARCHAR) AS source_id, page_id,
    regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS company,
    regexp_extract(url, '://([^/]+)', 1) AS location,
    html AS description, url,
    CASE WHEN regexp_extract(url, '/(\d+)', 1) <> '' THEN DATE '2024-01-01'
      + CAST(CAST(regexp_extract(url, '/(\d+)', 1) AS BIGINT) // 100 AS INTEGER) END AS posted_at
  FROM pages)"""


# --- text helpers for SQL twins -----------------------------------------------------
def sql_fold(text: str) -> str:
    return rf"lower(regexp_replace(strip_accents({text}), '[^\x00-\x7F]', '', 'g'))"


def sql_any(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text}, {sql_text(t)})" for t in terms) + ")"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_ascii_words(text: str) -> str:
    """Word characters outside ASCII become ``_``, other signs a space: makes the
    ASCII word boundary of the SQL engine agree with the Unicode one."""
    spaced = rf"regexp_replace({text}, '[^\x00-\x7F\p{{L}}\p{{N}}\p{{M}}]', ' ', 'g')"
    return rf"regexp_replace({spaced}, '[^\x00-\x7F]', '_', 'g')"


def sql_sort_tokens(text: str) -> str:
    return (
        rf"array_to_string(list_sort(list_filter(string_split_regex({text}, '\s+'),"
        rf" lambda w: w <> '')), ' ')"
    )


def sql_window(day: str) -> str:
    return f"coalesce(CAST((date_diff('day', DATE '1970-01-01', {day}) + 719163) // 3 AS VARCHAR), 'unknown')"
