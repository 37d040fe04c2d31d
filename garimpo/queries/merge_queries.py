"""Keyed merges and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookups as L
from ..operators import merge as M
from ..plans import silver as P
from ..session import shared_folder
from ..sources.tables import write_bucketed
from . import stand_ins as S
from .registry import REGISTRY, query, table

LINES_SQL = """
lines AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE)) AS id,
    l_returnflag AS source,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey AS VARCHAR) END AS source_id,
    'part ' || l_partkey AS description, l_shipdate AS ingested_at, l_linestatus AS status
  FROM lineitem)"""


def lines(spark, folder):
    """Raw postings: order lines; the order is the source id, line 7 has none."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date")
        ).alias("id"),
        F.col("l_returnflag").alias("source"),
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey").cast("string")).alias("source_id"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("description"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        F.col("l_linestatus").alias("status"),
    )


@query("insert_if_absent", f"""
  WITH {LINES_SQL}, target AS (SELECT * FROM lines WHERE status = 'O'),
  fresh AS (
    SELECT id, source, source_id FROM (
      SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY ingested_at, id) AS rn
      FROM lines WHERE source_id IS NOT NULL) b
    WHERE rn = 1 AND NOT EXISTS (
      SELECT 1 FROM target t WHERE t.source = b.source AND t.source_id = b.source_id)
    UNION ALL SELECT id, source, source_id FROM lines WHERE source_id IS NULL)
  SELECT 'new' AS kind, id, source, source_id FROM fresh
  UNION ALL SELECT 'old', id, source, source_id FROM target""")
def insert_if_absent(spark, folder):
    """Open lines are known; all lines arrive again."""
    batch = lines(spark, folder)
    target = batch.filter("status = 'O'").withColumn("kind", F.lit("old"))
    incoming = batch.withColumn("kind", F.lit("new"))
    merged = M.insert_if_absent(
        target, incoming, ["source", "source_id"], [F.col("ingested_at"), F.col("id")], "source_id"
    )
    return merged.select("kind", "id", "source", "source_id")


@query("insert_by_hash", S.on_jobs("""
  , hashed AS (
    SELECT sha256(concat_ws('|', company_id, posted_at)) AS dedup_hash, job_id, is_active FROM jobs),
  target AS (SELECT * FROM hashed WHERE is_active)
  SELECT dedup_hash, job_id FROM target
  UNION ALL
  SELECT dedup_hash, job_id FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_hash ORDER BY job_id) AS rn FROM hashed)
  WHERE rn = 1 AND dedup_hash NOT IN (SELECT dedup_hash FROM target)"""))
def insert_by_hash(spark, folder):
    """One job per identity hash; active jobs are known."""
    hashed = S.jobs(spark, folder).select(
        F.sha2(F.concat_ws("|", "company_id", "posted_at"), 256).alias("dedup_hash"), "job_id", "is_active"
    )
    target = hashed.filter("is_active").select("dedup_hash", "job_id")
    return M.insert_if_absent(target, hashed.drop("is_active"), ["dedup_hash"], [F.col("job_id")])


@query("get_or_create_company", """
  WITH known AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'),
  named AS (
    SELECT CASE WHEN o_orderstatus = 'P' THEN upper(c_name) ELSE ' ' || c_name END AS name, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT id, name FROM known
  UNION ALL
  SELECT sha256('company' || chr(31) || trim(lower(name))) AS id, name FROM (
    SELECT *, row_number() OVER (PARTITION BY trim(lower(name)) ORDER BY o_orderkey) AS rn FROM named)
  WHERE rn = 1 AND trim(lower(name)) NOT IN (SELECT lower(trim(name)) FROM known)""")
def get_or_create_company(spark, folder):
    customer = table(spark, folder, "customer")
    known = customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")
    )
    named = table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("o_orderstatus") == "P", F.upper("c_name"))
        .otherwise(F.concat(F.lit(" "), "c_name")).alias("name"),
        "o_orderkey",
    )
    return L.get_or_create(known, named, "name", [F.col("o_orderkey")], "company")


@query("get_or_create_location", """
  WITH known AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS raw, FALSE AS is_remote FROM nation WHERE n_regionkey = 2),
  named AS (
    SELECT CASE WHEN o_orderstatus = 'P' THEN lower(n_name) ELSE n_name END AS raw,
      o_totalprice > 350000 AS is_remote, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT id, raw, is_remote FROM known
  UNION ALL
  SELECT sha256('location' || chr(31) || lower(raw)), raw, is_remote FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(raw) ORDER BY o_orderkey) AS rn FROM named)
  WHERE rn = 1 AND lower(raw) NOT IN (SELECT lower(raw) FROM known)""")
def get_or_create_location(spark, folder):
    nation = table(spark, folder, "nation")
    known = nation.filter("n_regionkey = 2").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("raw"), F.lit(False).alias("is_remote")
    )
    named = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("o_orderstatus") == "P", F.lower("n_name")).otherwise(F.col("n_name")).alias("raw"),
            (F.col("o_totalprice") > 350000).alias("is_remote"), "o_orderkey",
        )
    )
    return L.get_or_create(known, named, "raw", [F.col("o_orderkey")], "location", carry=["is_remote"])


@query("name_lookup", S.on_jobs("""
  SELECT trim(lower(name)) AS key, min(id) AS id FROM companies GROUP BY 1"""))
def name_lookup(spark, folder):
    return L.name_map(S.companies(spark, folder), "name")


@query("update_by_key", S.on_jobs("""
  SELECT job_id,
    CASE WHEN source_ids[1] IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')
         THEN 'ml_mlops' ELSE area END AS area,
    CASE WHEN source_ids[1] IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')
         THEN NULL ELSE seniority END AS seniority,
    title
  FROM jobs"""))
def update_by_key(spark, folder):
    """Orders with a returned line get new labels; a NULL label is set as well."""
    changes = (
        table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
        .select(F.col("l_orderkey").cast("string").alias("job_id")).distinct()
        .select("job_id", F.lit("ml_mlops").alias("area"), F.lit(None).cast("string").alias("seniority"))
    )
    updated = M.update_by_key(S.jobs(spark, folder), changes, "job_id", ["area", "seniority"])
    return updated.select("job_id", "area", "seniority", "title")


@query("deactivate_by_ids", S.on_jobs("""
  SELECT job_id, CASE WHEN job_id IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem
    WHERE l_quantity >= 45 AND l_returnflag = 'R') THEN FALSE ELSE is_active END AS is_active FROM jobs"""))
def deactivate_by_ids(spark, folder):
    ids = table(spark, folder, "lineitem").filter("l_quantity >= 45 and l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("string").alias("job_id")
    )
    updated = M.set_by_ids(S.jobs(spark, folder), ids, "job_id", {"is_active": F.lit(False)})
    return updated.select("job_id", "is_active")


@query("deactivate_by_age", S.on_jobs("""
  SELECT job_id, CASE WHEN is_active AND posted_at < DATE '1999-01-01' - 14 THEN FALSE ELSE is_active END AS is_active
  FROM jobs"""))
def deactivate_by_age(spark, folder):
    from ..functions.dates import older_than

    rule = F.col("is_active") & older_than(F.col("posted_at"), 14, "1999-01-01")
    return M.set_where(S.jobs(spark, folder), rule, {"is_active": F.lit(False)}).select("job_id", "is_active")


@query("append_to_array", S.on_jobs("""
  , extra AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS job_id, list_sort(list(DISTINCT 'P' || l_partkey)) AS items
    FROM lineitem GROUP BY 1)
  SELECT j.job_id, array_to_string(list_concat(j.source_ids, coalesce(e.items, [])), '|') AS source_ids
  FROM jobs j LEFT JOIN extra e ON j.job_id = e.job_id"""))
def append_to_array(spark, folder):
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("job_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("item"),
    )
    merged = M.append_to_array(S.jobs(spark, folder), items, "job_id", "source_ids", "item")
    return merged.select("job_id", F.array_join("source_ids", "|").alias("source_ids"))


@query("unprocessed_rows", S.on_jobs(f"""
  , {LINES_SQL}, done AS (SELECT unnest(source_ids) AS source_id FROM jobs WHERE is_active)
  SELECT id, source, source_id FROM lines r
  WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.source_id = r.source_id)"""))
def unprocessed_rows(spark, folder):
    known = S.jobs(spark, folder).filter("is_active")
    return L.unprocessed(lines(spark, folder), known).select("id", "source", "source_id")


@query("unprocessed_newest", S.on_jobs(f"""
  , {LINES_SQL}, done AS (SELECT unnest(source_ids) AS source_id FROM jobs WHERE is_active)
  SELECT id, source, source_id FROM lines r
  WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.source_id = r.source_id)
  ORDER BY ingested_at DESC NULLS FIRST, id LIMIT 5000"""))
def unprocessed_newest(spark, folder):
    """The run limit: the newest 5000 unprocessed rows."""
    known = S.jobs(spark, folder).filter("is_active")
    return L.unprocessed(lines(spark, folder), known, limit=5000).select("id", "source", "source_id")


@query("first_source_description", S.on_jobs(f"""
  , {LINES_SQL}, texts AS (
    SELECT source_id, arg_min(description, (ingested_at, id)) AS description FROM lines
    WHERE source_id IS NOT NULL GROUP BY source_id)
  SELECT j.job_id, t.description FROM jobs j LEFT JOIN texts t ON j.source_ids[1] = t.source_id"""))
def first_source_description(spark, folder):
    return L.with_description(S.jobs(spark, folder), lines(spark, folder)).select("job_id", "description")


@query("unclassified", S.on_jobs("SELECT job_id, title FROM jobs WHERE area IS NULL"))
def unclassified(spark, folder):
    return L.unclassified(S.jobs(spark, folder)).select("job_id", "title")


@query("unknown_active", S.on_jobs("""
  SELECT job_id, posted_at FROM (SELECT *, coalesce(area, 'unknown') AS a, coalesce(seniority, 'unknown') AS s FROM jobs)
  WHERE is_active AND posted_at >= DATE '1999-01-01' - 14 AND classification_source = 'unknown'
    AND (a = 'unknown' OR s = 'unknown')"""))
def unknown_active(spark, folder):
    return P.unknown_active(with_unknown(S.jobs(spark, folder)), "1999-01-01").select("job_id", "posted_at")


def with_unknown(jobs):
    return jobs.withColumns({
        c: F.coalesce(c, F.lit("unknown")) for c in ("area", "seniority")
    })


@query("active_recent", S.on_jobs("""
  SELECT job_id, url FROM jobs WHERE is_active AND posted_at >= DATE '1999-01-01' - 14"""))
def active_recent(spark, folder):
    return P.active_recent(S.jobs(spark, folder), "1999-01-01").select("job_id", "url")


@query("candidates_scan", S.on_jobs("""
  SELECT j.job_id, j.title, j.posted_at, c.name AS company_name, l.raw AS location_raw
  FROM jobs j LEFT JOIN companies c ON j.company_id = c.id LEFT JOIN locations l ON j.location_id = l.id"""))
def candidates_scan(spark, folder):
    return L.jobs_with_names(
        S.jobs(spark, folder), S.companies(spark, folder), S.locations(spark, folder)
    ).select("job_id", "title", "posted_at", "company_name", "location_raw")


# --- silver tables in buckets of their key ----------------------------------------
def stored_jobs(spark, folder):
    """The jobs as a silver table: buckets of job_id, sorted within."""
    return write_bucketed(S.jobs(spark, folder), shared_folder(spark, "silver"), "jobs", "job_id", 8)


@query("update_bucketed", REGISTRY["update_by_key"].sql)
def update_bucketed(spark, folder):
    """``update_by_key`` on the stored table: the changes alone are shuffled."""
    changes = (
        table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
        .select(F.col("l_orderkey").cast("string").alias("job_id")).distinct()
        .select("job_id", F.lit("ml_mlops").alias("area"), F.lit(None).cast("string").alias("seniority"))
    )
    updated = M.update_by_key(stored_jobs(spark, folder), changes, "job_id", ["area", "seniority"])
    return updated.select("job_id", "area", "seniority", "title")


@query("append_bucketed", REGISTRY["append_to_array"].sql)
def append_bucketed(spark, folder):
    """``append_to_array`` on the stored table."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("job_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("item"),
    )
    merged = M.append_to_array(stored_jobs(spark, folder), items, "job_id", "source_ids", "item")
    return merged.select("job_id", F.array_join("source_ids", "|").alias("source_ids"))


@query("insert_thin", REGISTRY["insert_if_absent"].sql)
def insert_thin(spark, folder):
    """``insert_if_absent`` with keys and ids alone in the rank; the target is stored in buckets of the source id."""
    batch = lines(spark, folder)
    known = batch.filter("status = 'O'").withColumn("kind", F.lit("old"))
    target = write_bucketed(known, shared_folder(spark, "silver"), "raw", "source_id", 8)
    merged = M.insert_if_absent(
        target, batch.withColumn("kind", F.lit("new")), ["source", "source_id"],
        [F.col("ingested_at"), F.col("id")], "source_id", "id",
    )
    return merged.select("kind", "id", "source", "source_id")
