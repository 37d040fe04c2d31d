"""The run log and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import merge as M
from ..plans import runs as R
from . import stand_ins as S
from .registry import query, table, texts

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def stamped(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query("upsert_run_log", S.on_runs(f"""
  , log AS (SELECT * FROM run_log WHERE execution_date < DATE '2024-01-20'),
  starts AS (SELECT execution_date, started_at + INTERVAL 1 HOUR AS started_at FROM run_log
             WHERE execution_date >= DATE '2024-01-15')
  SELECT coalesce(l.execution_date, s.execution_date) AS execution_date,
    {STAMP.format('coalesce(s.started_at, l.started_at)')} AS started_at,
    CASE WHEN s.execution_date IS NULL THEN {STAMP.format('l.ended_at')} END AS ended_at,
    CASE WHEN s.execution_date IS NULL THEN l.status ELSE 'RUNNING' END AS status,
    coalesce(l.raw_inserted, 0) AS raw_inserted, coalesce(l.dedup_new, 0) AS dedup_new,
    CASE WHEN s.execution_date IS NULL THEN l.error_message END AS error_message
  FROM log l FULL JOIN starts s ON l.execution_date = s.execution_date"""))
def upsert_run_log(spark, folder):
    """Days before the 20th are logged; days from the 15th start again."""
    everything = S.run_log(spark, folder)
    log = everything.filter("execution_date < date'2024-01-20'")
    starts = everything.filter("execution_date >= date'2024-01-15'").select(
        "execution_date", (F.col("started_at") + F.expr("interval 1 hour")).alias("started_at")
    )
    return stamped(R.started(log, starts), "started_at", "ended_at").select(
        "execution_date", "started_at", "ended_at", "status", "raw_inserted", "dedup_new", "error_message"
    )


@query("update_run_log", S.on_runs("""
  SELECT l.execution_date, CASE WHEN e.day IS NULL THEN l.adzuna_count ELSE e.n END AS adzuna_count,
    CASE WHEN e.day IS NULL THEN l.raw_inserted ELSE e.total END AS raw_inserted,
    CASE WHEN e.day IS NULL THEN l.dedup_new ELSE e.n END AS dedup_new, l.dedup_duplicates,
    CASE WHEN e.day IS NULL THEN l.status ELSE 'SUCCESS' END AS status,
    CASE WHEN e.day IS NULL THEN l.classified_count ELSE e.n END AS classified_count
  FROM run_log l LEFT JOIN (
    SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS INTEGER) AS total,
      CAST(count(*) FILTER (event_type = 'error') AS INTEGER) AS n
    FROM events WHERE value >= 40 GROUP BY 1) e ON l.execution_date = e.day"""))
def update_run_log(spark, folder):
    """Extract, dedup and end counters of the days with a large event."""
    log = S.run_log(spark, folder)
    day = table(spark, folder, "events").filter("value >= 40").groupBy(
        F.col("ts").cast("date").alias("execution_date")
    ).agg(
        F.count(F.lit(1)).cast("int").alias("raw_inserted"),
        F.count_if(F.col("event_type") == "error").cast("int").alias("adzuna_count"),
    )
    log = R.record(log, day, ["adzuna_count", "raw_inserted"])
    log = R.record(log, day.withColumn("dedup_new", F.col("adzuna_count")), ["dedup_new"])
    ended = day.select("execution_date", F.lit("SUCCESS").alias("status"),
                       F.col("adzuna_count").alias("classified_count"))
    return R.record(log, ended, ["status", "classified_count"]).select(
        "execution_date", "adzuna_count", "raw_inserted", "dedup_new", "dedup_duplicates", "status",
        "classified_count",
    )


@query("run_status", S.on_runs(f"""
  SELECT execution_date, {STAMP.format('started_at')} AS started_at, {STAMP.format('ended_at')} AS ended_at,
    status, adzuna_count, jooble_count, remoteok_count, gupy_count, raw_inserted, dedup_new,
    dedup_duplicates, classified_count, error_message
  FROM run_log ORDER BY execution_date DESC LIMIT 1"""))
def run_status(spark, folder):
    return stamped(R.status(S.run_log(spark, folder)), "started_at", "ended_at")


HISTORY = f"""
  SELECT execution_date AS day, {STAMP.format('started_at')} AS started_at, {STAMP.format('ended_at')} AS ended_at,
    CAST(round(epoch_us(ended_at) / 1e6 - epoch_us(started_at) / 1e6) AS INTEGER) AS seconds, status,
    raw_inserted, dedup_new, dedup_duplicates, classified_count, error_message
  FROM run_log"""


@query("run_history", S.on_runs(HISTORY + " ORDER BY execution_date DESC LIMIT 20"))
def run_history(spark, folder):
    return stamped(R.history(S.run_log(spark, folder), 20), "started_at", "ended_at")


@query("run_history_failed", S.on_runs(HISTORY + " WHERE status = 'FAILED' ORDER BY execution_date DESC LIMIT 30"))
def run_history_failed(spark, folder):
    return stamped(R.history(S.run_log(spark, folder), only="FAILED"), "started_at", "ended_at")


@query("run_display", S.on_runs("""
  SELECT strftime(execution_date, '%d/%m/%Y') AS day, strftime(started_at, '%d/%m/%Y %H:%M:%S') AS started,
    coalesce(strftime(ended_at, '%d/%m/%Y %H:%M:%S'), 'Em Execução...') AS ended, status, raw_inserted,
    dedup_new, dedup_duplicates, classified_count
  FROM run_log ORDER BY execution_date DESC LIMIT 30"""))
def run_display(spark, folder):
    return R.history_display(R.history(S.run_log(spark, folder))).drop("seconds", "error_message")


@query("run_series_long", S.on_runs("""
  , last AS (SELECT * FROM run_log ORDER BY execution_date DESC LIMIT 14)
  SELECT execution_date AS day, 'Adzuna' AS source, adzuna_count AS jobs FROM last
  UNION ALL SELECT execution_date, 'Jooble', jooble_count FROM last
  UNION ALL SELECT execution_date, 'RemoteOK', remoteok_count FROM last
  UNION ALL SELECT execution_date, 'Gupy', gupy_count FROM last"""))
def run_series_long(spark, folder):
    return R.long_series(R.daily_series(S.run_log(spark, folder), 14))


@query("run_latency", S.on_runs(f"""
  SELECT day, seconds FROM ({HISTORY} ORDER BY execution_date DESC LIMIT 30) WHERE status = 'SUCCESS'"""))
def run_latency(spark, folder):
    return R.latency(R.history(S.run_log(spark, folder)))


@query("dedup_rate", S.on_runs("""
  SELECT execution_date, CASE WHEN raw_inserted > 0
    THEN CAST(round(100.0 * dedup_duplicates / raw_inserted, 1) AS DOUBLE) ELSE 0.0 END AS dedup_rate
  FROM run_log"""))
def dedup_rate(spark, folder):
    rate = R.dedup_rate(F.col("raw_inserted"), F.col("dedup_duplicates"))
    return S.run_log(spark, folder).select("execution_date", rate.cast("double").alias("dedup_rate"))


# --- unmapped terms ---------------------------------------------------------------
def document_terms(spark, folder):
    """(job_id, word, occurred_at) of the new terms in all documents."""
    rows = texts(spark, folder, "documents", "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.explode(rules.new_terms(F.col("text"))).alias("word"),
    )
    return rows.withColumn("occurred_at", F.lit(S.RUN_AT).cast("timestamp"))


def terms_sql() -> str:
    from ..functions import fixed_values as V

    skip = sorted({w.lower() for w in [*rules.all_known_skills(), *V.STOP_WORDS]})
    listed = ", ".join(S.sql_text(w) for w in skip)
    strip = S.sql_text(V.NEW_TERM_STRIP)
    return rf"""
terms AS (
  SELECT DISTINCT CAST(doc_id AS VARCHAR) AS job_id, word FROM (
    SELECT doc_id, trim(unnest(regexp_extract_all({S.sql_ascii_words("text")},
      '\b[A-Z][a-zA-Z0-9+#.\-/]*')), {strip}) AS word
    FROM documents)
  WHERE length(word) BETWEEN 2 AND 20 AND lower(word) NOT IN ({listed}))"""


@query("new_terms", f"WITH {terms_sql()} SELECT job_id, word FROM terms")
def new_terms(spark, folder):
    return document_terms(spark, folder).select("job_id", "word")


@query("unmapped_ranking", f"""
  WITH {terms_sql()} SELECT word, count(*) AS occurrences, DATE '2024-02-01' AS last_seen
  FROM terms GROUP BY word ORDER BY occurrences DESC, word LIMIT 50""")
def unmapped_ranking(spark, folder):
    return R.unmapped_ranking(document_terms(spark, folder))


@query("unmapped_examples", S.on_jobs(f"""
  , {terms_sql()}
  SELECT j.job_id, j.title, c.name AS company, j.url
  FROM terms u JOIN jobs j ON u.job_id = j.job_id JOIN companies c ON j.company_id = c.id
  WHERE u.word = 'And' ORDER BY j.job_id LIMIT 10"""))
def unmapped_examples(spark, folder):
    return R.unmapped_examples(
        document_terms(spark, folder), S.jobs(spark, folder), S.companies(spark, folder), "And"
    )


@query("append_terms", f"""
  WITH {terms_sql()} SELECT word, count(*) AS n FROM (
    SELECT word FROM terms UNION ALL SELECT event_type FROM events) GROUP BY word""")
def append_terms(spark, folder):
    """New terms appended to an existing log."""
    log = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("job_id"), F.col("event_type").alias("word"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
    )
    return M.append_rows(log, document_terms(spark, folder)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
