"""Similarity and entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_window
from ..functions.similarity import token_ratio
from ..functions.text import fold_strip, sort_tokens
from ..operators import resolve as R
from ..plans import silver as P
from ..schemas import COMPANIES, JOBS, LOCATIONS
from ..session import stored
from . import stand_ins as S
from .registry import query, table, texts

# Longest common subsequence of all pairs (k, a, b), one character of b per step: the
# zero bits of ``open`` count it.  128-bit numbers hold texts of up to 120 characters.
LCS_SQL = """
lcs AS (
  SELECT k, a, b, 0 AS i, (CAST(1 AS HUGEINT) << length(a)) - 1 AS full_bits,
    (CAST(1 AS HUGEINT) << length(a)) - 1 AS open FROM pairs
  UNION ALL
  SELECT k, a, b, i + 1, full_bits, ((open + hit) | (open - hit)) & full_bits
  FROM (
    SELECT *, open & coalesce(CAST(list_sum(list_transform(range(0, length(a)), lambda p:
      CASE WHEN substr(a, p + 1, 1) = substr(b, i + 1, 1) THEN CAST(1 AS HUGEINT) << CAST(p AS INTEGER)
           ELSE CAST(0 AS HUGEINT) END)) AS HUGEINT), 0) AS hit
    FROM lcs WHERE i < length(b))),
scored AS (SELECT k, length(a) - bit_count(open) AS shared, length(a) + length(b) AS total
           FROM lcs WHERE i = length(b))"""


def part_pairs(spark, folder):
    title = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    parts = table(spark, folder, "part").select("p_partkey", sort_tokens(fold_strip(title)).alias("title"))
    following = parts.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("title").alias("next_title"))
    return parts.join(following, "p_partkey")


@query("token_sort_ratio", f"""
  WITH RECURSIVE titles AS (
    SELECT p_partkey, {S.sql_sort_tokens("lower(concat_ws(' ', p_name, p_type, p_brand))")} AS t FROM part),
  pairs AS (SELECT x.p_partkey AS k, x.t AS a, y.t AS b FROM titles x JOIN titles y ON y.p_partkey = x.p_partkey + 1),
  {LCS_SQL}
  SELECT k AS p_partkey, round(200.0 * shared / total, 6) AS ratio FROM scored""")
def token_sort_ratio(spark, folder):
    """Every part against the next one."""
    score = token_ratio(F.col("title"), F.col("next_title"))
    return part_pairs(spark, folder).select("p_partkey", F.round(score, 6).alias("ratio"))


# --- pages ------------------------------------------------------------------------
def page_nodes(spark, folder):
    return R.keyed_postings(
        S.page_postings(spark, folder), "title", "company", "posted_at",
        R.raw_order(F.col("ingested_at"), F.col("id")), ["id"],
    )


# Nodes in order; company pairs first, titles only where the companies reach 90.
# ``known`` tells which postings are jobs already; those come first, oldest first.
LEADERS_SQL = f"""
WITH RECURSIVE {S.PAGES_SQL},
keyed AS (
  SELECT id, page_id, {{known}} AS known, location, {S.sql_window("posted_at")} AS bucket,
    {S.sql_sort_tokens(S.sql_fold("title"))} AS t, {S.sql_sort_tokens(S.sql_fold("company"))} AS c,
    trim({S.sql_fold("title")}) AS title_norm, trim({S.sql_fold("company")}) AS company_norm
  FROM postings),
nodes AS MATERIALIZED (
  SELECT bucket, t, c, max(id) AS id, bool_or(known) AS forced, min(id) FILTER (known) AS known_id,
    row_number() OVER (ORDER BY bool_or(known) DESC,
      CASE WHEN bool_or(known) THEN min(page_id) FILTER (known) ELSE -max(page_id) END) AS n
  FROM keyed WHERE t <> '' AND c <> '' GROUP BY bucket, t, c),
names AS (SELECT DISTINCT c FROM nodes),
name_pairs AS (
  SELECT row_number() OVER (ORDER BY x.c, y.c) AS k, x.c AS a, y.c AS b FROM names x JOIN names y
  ON x.c < y.c AND 200 * least(length(x.c), length(y.c)) >= 90 * (length(x.c) + length(y.c))),
name_lcs AS MATERIALIZED ({{name_lcs}}),
alike AS MATERIALIZED (
  SELECT a, b FROM name_pairs p JOIN name_lcs s ON p.k = s.k WHERE 200 * s.shared >= 90 * s.total
  UNION ALL SELECT b, a FROM name_pairs p JOIN name_lcs s ON p.k = s.k WHERE 200 * s.shared >= 90 * s.total
  UNION ALL SELECT c, c FROM names),
title_pairs AS (
  SELECT x.n * 1000000 + y.n AS k, x.n AS first, y.n AS later, x.t AS a, y.t AS b
  FROM nodes x JOIN alike ON x.c = alike.a JOIN nodes y ON y.c = alike.b
  WHERE x.bucket = y.bucket AND x.n < y.n
    AND 200 * least(length(x.t), length(y.t)) >= 85 * (length(x.t) + length(y.t))),
title_lcs AS MATERIALIZED ({{title_lcs}}),
edges AS MATERIALIZED (SELECT first, later FROM title_pairs p JOIN title_lcs s ON p.k = s.k WHERE 200 * s.shared >= 85 * s.total),
earlier AS MATERIALIZED (SELECT n, forced, list_filter(list(first), lambda x: x IS NOT NULL) AS firsts
            FROM nodes LEFT JOIN edges ON n = later GROUP BY n, forced),
greedy AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS leads, CAST(NULL AS BIGINT) AS chosen
  UNION ALL
  SELECT e.n, CASE WHEN NOT e.forced AND list_has_any(g.leads, e.firsts) THEN g.leads ELSE list_append(g.leads, e.n) END,
    coalesce(list_min(list_intersect(g.leads, e.firsts)), e.n)
  FROM greedy g JOIN earlier e ON e.n = g.n + 1)
"""


def _lcs_of(pairs: str) -> str:
    """The LCS recursion over a named pair table as a subquery."""
    return f"WITH RECURSIVE pairs AS (SELECT k, a, b FROM {pairs}), {LCS_SQL} SELECT * FROM scored"


LEADERS_SQL = LEADERS_SQL.replace("{name_lcs}", _lcs_of("name_pairs")).replace("{title_lcs}", _lcs_of("title_pairs"))
KNOWN_SQL = LEADERS_SQL.replace("{known}", "starts_with(location, 'www.')")
LEADERS_SQL = LEADERS_SQL.replace("{known}", "FALSE")


@query("fuzzy_pairs", LEADERS_SQL + """
  SELECT k.id, lead.id AS leader_id
  FROM keyed k JOIN nodes own ON k.bucket = own.bucket AND k.t = own.t AND k.c = own.c
    JOIN greedy g ON g.n = own.n JOIN nodes lead ON lead.n = g.chosen""")
def fuzzy_pairs(spark, folder):
    """Every page posting with the posting that leads it."""
    postings = page_nodes(spark, folder)
    assigned = R.assign_leaders(R.nodes(postings, False))
    leads = R.nodes(postings, False).select(
        F.col("kid").alias("leader_kid"), F.substring("ord", 21, 40).alias("leader_id")
    )
    return postings.join(assigned, "kid").join(leads, "leader_kid").select("id", "leader_id")


@query("fuzzy_pairs_in_rounds", LEADERS_SQL + """
  SELECT k.id, lead.id AS leader_id
  FROM keyed k JOIN nodes own ON k.bucket = own.bucket AND k.t = own.t AND k.c = own.c
    JOIN greedy g ON g.n = own.n JOIN nodes lead ON lead.n = g.chosen""")
def fuzzy_pairs_in_rounds(spark, folder):
    """The same through components and distributed rounds, as very large windows take them."""
    postings = page_nodes(spark, folder)
    limits = R.Limits(group_nodes=3, block_companies=20, first_peel=4)
    assigned = R.assign_leaders(R.nodes(postings, False), limits=limits)
    leads = R.nodes(postings, False).select(
        F.col("kid").alias("leader_kid"), F.substring("ord", 21, 40).alias("leader_id")
    )
    return postings.join(assigned, "kid").join(leads, "leader_kid").select("id", "leader_id")


@query("fuzzy_dedup_counts", LEADERS_SQL + """
  SELECT count(*) FILTER (k.id = lead.id) AS new, count(*) FILTER (k.id <> lead.id) AS duplicate,
    (SELECT count(*) FROM keyed WHERE t = '' OR c = '') AS skipped
  FROM keyed k JOIN nodes own ON k.bucket = own.bucket AND k.t = own.t AND k.c = own.c
    JOIN greedy g ON g.n = own.n JOIN nodes lead ON lead.n = g.chosen""")
def fuzzy_dedup_counts(spark, folder):
    """Counters of the whole step over pages, without known jobs."""
    empty = [spark.createDataFrame([], schema) for schema in (JOBS, COMPANIES, LOCATIONS)]
    return P.resolve(S.page_postings(spark, folder), *empty, S.RUN_AT).stats


# All lines, window by window: letters bound the title pairs, masks per letter make a step of the LCS
# one lookup, and the loop runs in all windows at once.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789# "
LINES_DEDUP_SQL = f"""
WITH RECURSIVE postings AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE)) AS id,
    {S.sql_window("CAST(l_shipdate AS DATE)")} AS bucket, l_shipdate AS seen, l_partkey, l_suppkey FROM lineitem),
titles AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY t) AS k, t, length(t) AS size,
    list_transform(range(1, {len(LETTERS) + 1}), lambda c: length(t) - length(replace(t, substr('{LETTERS}', CAST(c AS INTEGER), 1), ''))) AS held,
    list_transform(range(0, length(t)), lambda p: strpos('{LETTERS}', substr(t, CAST(p AS INTEGER) + 1, 1))) AS codes,
    list_transform(range(1, {len(LETTERS) + 1}), lambda c: coalesce(CAST(list_sum(list_transform(range(0, length(t)), lambda p:
      CASE WHEN substr(t, CAST(p AS INTEGER) + 1, 1) = substr('{LETTERS}', CAST(c AS INTEGER), 1)
           THEN CAST(1 AS HUGEINT) << CAST(p AS INTEGER) ELSE CAST(0 AS HUGEINT) END)) AS HUGEINT), 0)) AS masks
  FROM (SELECT DISTINCT t FROM (
    SELECT {S.sql_sort_tokens("lower(concat_ws(' ', p_name, p_type, p_brand))")} AS t FROM part
    UNION ALL SELECT {S.sql_sort_tokens("lower(s_name)")} FROM supplier))),
parts AS (
  SELECT p_partkey, k AS title FROM part JOIN titles
  ON t = {S.sql_sort_tokens("lower(concat_ws(' ', p_name, p_type, p_brand))")}),
suppliers AS (
  SELECT s_suppkey, k AS company FROM supplier JOIN titles ON t = {S.sql_sort_tokens("lower(s_name)")}),
keyed AS MATERIALIZED (
  SELECT id, bucket, title, company, seen FROM postings JOIN parts ON l_partkey = p_partkey JOIN suppliers ON l_suppkey = s_suppkey),
nodes AS MATERIALIZED (
  SELECT bucket, title, company, row_number() OVER (PARTITION BY bucket ORDER BY first) AS n
  FROM (SELECT bucket, title, company, min(struct_pack(back := -epoch_us(seen), id := id)) AS first FROM keyed GROUP BY ALL)),
wanted AS MATERIALIZED (
  SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, need FROM (
    SELECT x.company AS a, y.company AS b, 90 AS need FROM (SELECT DISTINCT company FROM nodes) x
    JOIN (SELECT DISTINCT company FROM nodes) y ON x.company < y.company
    UNION ALL
    SELECT x.title, y.title, 85 FROM nodes x JOIN nodes y ON x.bucket = y.bucket AND x.n < y.n AND x.title <> y.title)),
possible AS MATERIALIZED (
  SELECT a, b, need FROM wanted JOIN titles x ON x.k = a JOIN titles y ON y.k = b
  WHERE 200 * least(x.size, y.size) >= need * (x.size + y.size)
    AND 200 * list_sum(list_transform(list_zip(x.held, y.held), lambda z: least(z[1], z[2]))) >= need * (x.size + y.size)),
lcs AS (
  SELECT a, b, need, 0 AS i, (CAST(1 AS HUGEINT) << CAST(size AS INTEGER)) - 1 AS open FROM possible JOIN titles ON k = a
  UNION ALL
  SELECT a, b, need, i + 1, ((open + hit) | (open - hit)) & ((CAST(1 AS HUGEINT) << CAST(size AS INTEGER)) - 1)
  FROM (SELECT l.a, l.b, l.need, l.i, l.open, x.size, l.open & x.masks[y.codes[l.i + 1]] AS hit
        FROM lcs l JOIN titles x ON x.k = l.a JOIN titles y ON y.k = l.b WHERE l.i < y.size)),
alike AS MATERIALIZED (
  SELECT a, b, need FROM lcs JOIN titles x ON x.k = a JOIN titles y ON y.k = b
  WHERE i = y.size AND 200 * (x.size - bit_count(open)) >= need * (x.size + y.size)),
pairs AS MATERIALIZED (
  SELECT a, b, need FROM alike UNION ALL SELECT b, a, need FROM alike
  UNION ALL SELECT k, k, 85 FROM titles UNION ALL SELECT k, k, 90 FROM titles),
edges AS (
  SELECT y.bucket, x.n AS first, y.n AS later FROM nodes x JOIN pairs t ON t.a = x.title AND t.need = 85
  JOIN nodes y ON y.bucket = x.bucket AND y.title = t.b AND x.n < y.n
  JOIN pairs c ON c.a = x.company AND c.b = y.company AND c.need = 90),
earlier AS MATERIALIZED (
  SELECT n.bucket, n.n, list_filter(list(first), lambda x: x IS NOT NULL) AS firsts
  FROM nodes n LEFT JOIN edges e ON e.bucket = n.bucket AND e.later = n.n GROUP BY ALL),
greedy AS (
  SELECT DISTINCT bucket, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS leads, CAST(NULL AS BIGINT) AS chosen FROM nodes
  UNION ALL
  SELECT e.bucket, e.n, CASE WHEN list_has_any(g.leads, e.firsts) THEN g.leads ELSE list_append(g.leads, e.n) END,
    coalesce(list_min(list_intersect(g.leads, e.firsts)), e.n)
  FROM greedy g JOIN earlier e ON e.bucket = g.bucket AND e.n = g.n + 1),
named AS (
  SELECT bucket, title, company, n, md5(concat_ws(chr(31), bucket, x.t, y.t)) AS kid
  FROM nodes JOIN titles x ON x.k = title JOIN titles y ON y.k = company)
"""


@query("fuzzy_dedup", LINES_DEDUP_SQL + """
  SELECT k.id, own.kid, lead.kid AS leader_kid
  FROM keyed k JOIN named own ON own.bucket = k.bucket AND own.title = k.title AND own.company = k.company
  JOIN greedy g ON g.bucket = own.bucket AND g.n = own.n JOIN named lead ON lead.bucket = own.bucket AND lead.n = g.chosen""")
def fuzzy_dedup(spark, folder):
    """All order lines as postings: part as title, supplier as company, ship date."""
    return _deduped(line_postings(spark, folder))


def line_postings(spark, folder):
    return (
        texts(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws(
                "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date")
            ).alias("id"),
            F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title"),
            F.col("s_name").alias("company"),
            F.col("l_shipdate").cast("date").alias("posted_at"),
            F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        )
    )


def _deduped(rows):
    postings = R.keyed_postings(
        rows, "title", "company", "posted_at", R.raw_order(F.col("ingested_at"), F.col("id")), ["id"]
    )
    # Joined and folded once: the nodes and the last join both read what is kept.
    postings = stored(postings.select("id", "kid", "window", "title_k", "company_k", "ord"), "postings")
    assigned = R.assign_leaders(R.nodes(postings, False))
    return postings.select("id", "kid").join(assigned, "kid").select("id", "kid", "leader_kid")


@query("fuzzy_dedup_undated")
def fuzzy_dedup_undated(spark, folder):
    """The same without dates: all lines in one crowded window, decided in rounds.

    No SQL: its loop has tens of thousands of steps over one list.  ``tests/test_resolve.py``
    compares the rounds with the plain loop.
    """
    return _deduped(line_postings(spark, folder).withColumn("posted_at", F.lit(None).cast("date")))


@query("resolve_postings", KNOWN_SQL + """
  , led AS (
    SELECT k.id, k.bucket, k.title_norm, k.company_norm, k.location, lead.id AS founder, lead.forced,
      lead.known_id
    FROM keyed k JOIN nodes own ON k.bucket = own.bucket AND k.t = own.t AND k.c = own.c
      JOIN greedy g ON g.n = own.n JOIN nodes lead ON lead.n = g.chosen),
  made AS (
    SELECT id AS founder, sha256('job' || chr(31) || sha256(concat_ws('|', title_norm, company_norm,
      CASE WHEN location = '' THEN 'desconhecido' ELSE location END, bucket))) AS job_id
    FROM led WHERE id = founder)
  SELECT k.id, CASE WHEN l.id IS NULL THEN 'skipped' WHEN NOT l.forced AND l.id = l.founder THEN 'new'
      ELSE 'duplicate' END AS outcome,
    CASE WHEN l.forced THEN 'job-' || l.known_id ELSE m.job_id END AS job_id
  FROM keyed k LEFT JOIN led l ON k.id = l.id LEFT JOIN made m ON l.founder = m.founder""")
def resolve_postings(spark, folder):
    """Page postings against known jobs: the pages of ``www`` hosts are known already."""
    pages = S.page_postings(spark, folder)
    known = pages.filter(F.col("location").startswith("www."))
    companies = known.select("company").distinct().select(
        F.md5("company").alias("id"), F.col("company").alias("name")
    )
    locations = known.select("location").distinct().select(
        F.md5("location").alias("id"), F.col("location").alias("raw"),
        *[F.lit(None).cast("string").alias(c) for c in ("city", "state", "country")],
        F.lit(False).alias("is_remote"),
    )
    jobs = known.select(
        F.concat(F.lit("job-"), F.col("id")).alias("job_id"),
        F.array(F.concat(F.lit("old-"), F.col("source_id"))).alias("source_ids"),
        F.sha2("id", 256).alias("dedup_hash"), "title",
        F.md5("company").alias("company_id"), F.md5("location").alias("location_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("area", "seniority")],
        F.array().cast("array<string>").alias("skills"), "url", "posted_at",
        F.lit(False).alias("is_remote"), F.lit(False).alias("is_hybrid"),
        F.col("ingested_at").alias("created_at"), F.lit(True).alias("is_active"),
        F.lit(None).cast("string").alias("classification_source"),
    )
    return P.resolve(pages, jobs, companies, locations, S.RUN_AT).mapping
