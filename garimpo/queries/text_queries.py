"""Folding, hashing, classification and term extraction over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules
from ..functions.dates import date_window
from ..functions.keys import identity_hash
from ..functions.text import contains_any, fold, fold_strip
from ..operators.merge import first_per_key
from ..plans import silver as P
from . import stand_ins as S
from .merge_queries import with_unknown
from .registry import query, table, texts

# Words that occur in the test documents, as a dictionary per language.
WORDS = {
    "en": ["that", "whan", "erat", "MIT License", "hein", "thsh"],
    "fr": ["elle", "de", "queaux", "mentre", "ai"],
    "de": ["der", "schst", "enau", "sich"],
    "es": ["del", "osde", "boque", "la"],
}
COMMON_WORDS = ["and", "en", "license", "the"]


@query("fold_text", f"""
  SELECT doc_id, md5({S.sql_fold("text")}) AS folded, CAST(length({S.sql_fold("text")}) AS INTEGER) AS size
  FROM documents""")
def fold_text(spark, folder):
    folded = fold(F.col("text"))
    return texts(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", F.md5(folded).alias("folded"), F.char_length(folded).alias("size")
    )


@query("date_window", f"SELECT o_orderkey, {S.sql_window('CAST(o_orderdate AS DATE)')} AS bucket FROM orders")
def window_of_date(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", date_window(F.col("o_orderdate").cast("date")).alias("bucket")
    )


def sql_strip(text: str) -> str:
    return f"trim({S.sql_fold(text)}, ' ' || chr(9) || chr(10) || chr(13))"


@query("dedup_hash", f"""
  WITH {S.PAGES_SQL}
  SELECT id, sha256(concat_ws('|', {sql_strip("title")}, {sql_strip("company")}, location,
    {S.sql_window("posted_at")})) AS dedup_hash FROM postings""")
def dedup_hash(spark, folder):
    return S.page_postings(spark, folder).select("id", identity_hash(
        fold_strip(F.col("title")), fold_strip(F.col("company")), F.col("location"), date_window(F.col("posted_at"))
    ).alias("dedup_hash"))


@query("exact_dedup", f"""
  SELECT dedup_hash, id FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_hash ORDER BY id) AS rn FROM (
      SELECT sha256(concat_ws('|', p_name, lower(s_name), l_returnflag,
          {S.sql_window("CAST(l_shipdate AS DATE)")})) AS dedup_hash,
        concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey))
  WHERE rn = 1""")
def exact_dedup(spark, folder):
    """One line per identity of part, supplier, flag and date window."""
    rows = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            identity_hash(
                fold_strip(F.col("p_name")), fold_strip(F.col("s_name")), F.col("l_returnflag"),
                date_window(F.col("l_shipdate").cast("date")),
            ).alias("dedup_hash"),
            F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
        )
    )
    return first_per_key(rows, ["dedup_hash"], [F.col("id")])


# --- area, seniority --------------------------------------------------------------
def sql_area(title: str, description: str) -> str:
    tools = " + ".join(f"CAST(contains({description}, '{t}') AS INTEGER)" for t in V.DATA_TOOLS)
    areas = " ".join(f"WHEN {S.sql_any(title, terms)} THEN '{area}'" for area, terms in V.AREA_TERMS.items())
    return f"""CASE
      WHEN NOT ({S.sql_any(title, V.TECH_TITLE_TERMS)} OR {S.sql_any(description, V.TECH_DESCRIPTION_TERMS)})
        THEN 'non_tech'
      WHEN NOT ({S.sql_any(title, V.DATA_TITLE_TERMS)}
        OR ({tools} >= 2 AND {S.sql_any(description, V.DATA_CONTEXT_TERMS)})) THEN 'non_data'
      {areas} END"""


def sql_seniority(title: str) -> str:
    return "CASE " + " ".join(
        f"WHEN regexp_matches({title}, '\\b({'|'.join(p)})\\b') THEN '{level}'"
        for level, p in V.SENIORITY_PATTERNS.items()
    ) + " END"


@query("classify_area", f"""
  SELECT doc_id, {sql_area("t", "t")} AS area FROM (SELECT doc_id, {S.sql_fold("text")} AS t FROM documents)""")
def classify_area(spark, folder):
    """The whole text serves as title and as description."""
    folded = texts(spark, folder, "documents", "doc_id", "text").select("doc_id", fold(F.col("text")).alias("t"))
    return folded.select("doc_id", rules.area_from_folded(F.col("t"), F.col("t")).alias("area"))


@query("classify_area_of_turns", f"""
  SELECT conv_id, turn, {sql_area("t", "''")} AS area FROM (
    SELECT conv_id, turn, {S.sql_fold("text")} AS t FROM conversations)""")
def classify_area_of_turns(spark, folder):
    return texts(spark, folder, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", rules.area(F.col("text")).alias("area"))


@query("classify_seniority", f"""
  SELECT doc_id, {sql_seniority("t")} AS seniority FROM (SELECT doc_id, {S.sql_fold("text")} AS t FROM documents)""")
def classify_seniority(spark, folder):
    return texts(spark, folder, "documents", "doc_id", "text").select("doc_id", rules.seniority(F.col("text")).alias("seniority"))


# --- skills -----------------------------------------------------------------------
def sql_skills(text: str, area: str, by_area: dict, universal: list) -> str:
    def found(terms):
        hits = ", ".join(
            f"CASE WHEN regexp_matches({text}, '(?i)\\b{t}\\b') THEN '{t}' END" for t in terms
        )
        return f"list_filter([{hits}], lambda x: x IS NOT NULL)"

    branches = " ".join(
        f"WHEN '{a}' THEN {found(list(dict.fromkeys([*terms, *universal])))}" for a, terms in by_area.items()
    )
    return f"array_to_string(CASE {area} {branches} ELSE {found(universal)} END, '|')"


@query("extract_skills", f"""
  SELECT doc_id, {sql_skills("t", "lang", WORDS, COMMON_WORDS)} AS skills FROM (
    SELECT doc_id, lang, {S.sql_ascii_words("text")} AS t FROM documents)""")
def extract_skills(spark, folder):
    """Dictionary of the document's language, then the common words."""
    found = rules.skills(F.col("text"), F.col("lang"), WORDS, COMMON_WORDS)
    return texts(spark, folder, "documents", "doc_id", "text", "lang").select("doc_id", F.array_join(found, "|").alias("skills"))


@query("classify_pages", f"""
  WITH {S.PAGES_SQL},
  folded AS (SELECT *, {S.sql_fold("title")} AS t, {S.sql_fold("description")} AS d,
    {S.sql_ascii_words("description")} AS w FROM postings),
  ruled AS (SELECT id, w, {sql_area("t", "d")} AS area, {sql_seniority("t")} AS seniority FROM folded)
  SELECT id, area, seniority, {sql_skills("w", "area", V.SKILLS_BY_AREA, V.UNIVERSAL_SKILLS)} AS skills,
    CASE WHEN area IS NOT NULL OR seniority IS NOT NULL THEN 'syntax' ELSE 'unknown' END AS classification_source
  FROM ruled""")
def classify_pages(spark, folder):
    """The whole rule set with its default lists: page title and whole page."""
    rows = S.page_postings(spark, folder).withColumnRenamed("id", "job_id")
    return P.classified_rows(rows).select(
        F.col("job_id").alias("id"), "area", "seniority", F.array_join("skills", "|").alias("skills"),
        "classification_source",
    )


@query("classify_step", f"""
  WITH {S.PAGES_SQL}, folded AS (SELECT id, {S.sql_fold("title")} AS t, {S.sql_fold("description")} AS d FROM postings)
  SELECT count(*) AS classified, count(*) FILTER ({sql_area("t", "d")} IS NULL) AS area_unknown,
    count(*) FILTER ({sql_seniority("t")} IS NULL) AS seniority_unknown FROM folded""")
def classify_step(spark, folder):
    """Counters of the whole step: jobs without area, their raw texts, the rules."""
    raw = S.page_postings(spark, folder)
    jobs = raw.select(
        F.col("id").alias("job_id"), "title", F.array("source_id").alias("source_ids"),
        *[F.lit(None).cast("string").alias(c) for c in ("area", "seniority", "classification_source")],
        F.array().cast("array<string>").alias("skills"),
    )
    return P.classify(jobs, raw, S.RUN_AT).stats


# --- work mode --------------------------------------------------------------------
def mode_rows(spark, folder):
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "view", "Engenheiro (Remoto)").when(kind == "click", "Analista Híbrida")
        .otherwise("Analista").alias("title"),
        F.when(value > 20, "Home Office").when(value > 10, "São Paulo - HÍBRIDO")
        .when(value > 5, "São Paulo").alias("location"),
        F.concat(
            F.when(kind == "signup", "Trabalho remoto. ").when(kind == "error", "Regime híbrido. ")
            .otherwise("100% Remote, not hybrid. "), F.col("props"),
        ).alias("description"),
        (value > 35).alias("flag"),
    )


MODE_SQL = """
rows AS (
  SELECT event_id, event_type, value,
    event_type = 'view' OR value > 20 OR event_type IN ('signup', 'purchase', 'view', 'click') AS says_remote,
    event_type = 'click' OR (value > 10 AND value <= 20) OR event_type = 'error' AS says_hybrid
  FROM events)"""


@query("work_mode", f"""
  WITH {MODE_SQL} SELECT event_id, (says_remote OR value > 35) AND NOT says_hybrid AS is_remote,
    says_hybrid AS is_hybrid FROM rows""")
def work_mode(spark, folder):
    mode = rules.work_mode(F.col("title"), F.col("location"), F.col("description"), F.col("flag"))
    return mode_rows(spark, folder).select("event_id", mode.alias("m")).select("event_id", "m.*")


@query("remote_at_load", f"""
  WITH {MODE_SQL} SELECT event_id, says_remote OR value > 35 AS is_remote,
    value > 20 AS card_is_remote FROM rows""")
def remote_at_load(spark, folder):
    remote = rules.remote_at_load(F.col("title"), F.col("location"), F.col("description"), F.col("flag"))
    card = contains_any(F.lower(F.coalesce("location", F.lit(""))), V.CARD_REMOTE_TERMS)
    return mode_rows(spark, folder).select("event_id", remote.alias("is_remote"), card.alias("card_is_remote"))


@query("work_mode_of_pages", f"""
  WITH {S.PAGES_SQL}, folded AS (SELECT id, {S.sql_fold("title")} AS t, {S.sql_fold("description")} AS d FROM postings),
  said AS (
    SELECT id, {S.sql_any("t", V.REMOTE_TERMS)} OR {S.sql_any("d", V.REMOTE_PHRASES)} AS remote,
      {S.sql_any("t", V.HYBRID_TERMS)} OR {S.sql_any("d", V.HYBRID_PHRASES)}
      OR ({S.sql_any("d", V.HYBRID_TERMS)} AND NOT {S.sql_any("d", V.FULL_REMOTE_PHRASES)}) AS hybrid
    FROM folded)
  SELECT id, remote AND NOT hybrid AS is_remote, hybrid AS is_hybrid FROM said""")
def work_mode_of_pages(spark, folder):
    mode = rules.work_mode(F.col("title"), F.lit(""), F.col("description"), F.col("is_remote"))
    return S.page_postings(spark, folder).select("id", mode.alias("m")).select("id", "m.*")


# --- labels -----------------------------------------------------------------------
def label_responses(spark, folder):
    quality, toxic = F.col("quality"), F.col("toxic")
    return table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.when((quality == 1) & (toxic == 0), '{"area": "data_science", "seniority": "senior"}')
        .when((quality == 1) & (toxic == 1), '{"area": "web", "seniority": "pleno"}')
        .when((quality == 0) & (toxic == 0), "{}")
        .otherwise("quota exceeded").alias("response"),
    )


LABELS_SQL = """
, known AS (
  SELECT job_id, coalesce(area, 'unknown') AS area, coalesce(seniority, 'unknown') AS seniority, posted_at,
    is_active, classification_source, skills FROM jobs),
answered AS (
  SELECT k.job_id, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'data_science' ELSE 'unknown' END AS area,
    CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'senior' WHEN l.quality = 1 THEN 'pleno' ELSE 'unknown' END AS seniority,
    l.quality = 1 AS success
  FROM known k JOIN labels l ON k.job_id = CAST(l.doc_id AS VARCHAR)
  WHERE k.is_active AND k.posted_at >= DATE '1996-01-01' - 14 AND k.classification_source = 'unknown'
    AND (k.area = 'unknown' OR k.seniority = 'unknown'))"""


@query("apply_labels", S.on_jobs(LABELS_SQL + """
  SELECT k.job_id, CASE WHEN a.success THEN a.area ELSE k.area END AS area,
    CASE WHEN a.success THEN a.seniority ELSE k.seniority END AS seniority,
    CASE WHEN a.success THEN 'ia' ELSE k.classification_source END AS classification_source,
    array_to_string(k.skills, '|') AS skills
  FROM known k LEFT JOIN answered a ON k.job_id = a.job_id"""))
def apply_labels(spark, folder):
    jobs = with_unknown(S.jobs(spark, folder))
    labelled = P.apply_labels(jobs, label_responses(spark, folder), "1996-01-01")
    return labelled.jobs.select(
        "job_id", "area", "seniority", "classification_source", F.array_join("skills", "|").alias("skills")
    )


@query("label_counts", S.on_jobs(LABELS_SQL + """
  SELECT count(*) AS processed, count(*) FILTER (success) AS success, count(*) FILTER (NOT success) AS failed
  FROM answered"""))
def label_counts(spark, folder):
    jobs = with_unknown(S.jobs(spark, folder))
    return P.apply_labels(jobs, label_responses(spark, folder), "1996-01-01").stats


# --- expiry -----------------------------------------------------------------------
def fetched(spark, folder):
    """Pages as fetched responses; their addresses decide on status and failure."""
    url = F.col("url")
    return table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("job_id"),
        F.when(url.endswith("#top"), 404).when(url.endswith(".html"), 410)
        .when(~url.contains("page=2"), 200).alias("status_code"),
        F.when(url.contains("/es/"), F.concat(url, F.lit("/Expired"))).otherwise(url).alias("final_url"),
        F.when(url.contains("/fr/"), F.concat("html", F.lit(" Vaga não disponível")))
        .otherwise(F.col("html")).alias("html"),
        F.when(url.contains("page=2"), "timeout").alias("error"),
    )


PAGE_ACTIVE = """contains(url, 'page=2') OR NOT (url LIKE '%#top' OR url LIKE '%.html'
  OR contains(url, '/es/') OR contains(lower(url), 'expired')
  OR contains(url, '/fr/') OR contains({html}, 'finalizada') OR contains({html}, 'vaga expirada'))""".format(
    html=S.sql_fold("html"))


@query("page_activity", f"SELECT CAST(page_id AS VARCHAR) AS job_id, {PAGE_ACTIVE} AS is_active FROM pages")
def page_activity(spark, folder):
    active = rules.page_is_active(F.col("status_code"), F.col("final_url"), F.col("html"), F.col("error"))
    return fetched(spark, folder).select("job_id", active.alias("is_active"))


EXPIRE_SQL = f"""
, closed AS (SELECT CAST(page_id AS VARCHAR) AS job_id FROM pages WHERE NOT ({PAGE_ACTIVE})),
hits AS (
  SELECT job_id FROM jobs WHERE is_active AND posted_at >= DATE '1998-01-01' - 14 AND url <> ''
    AND job_id IN (SELECT job_id FROM closed))"""


@query("expire_postings", S.on_jobs(EXPIRE_SQL + """
  SELECT job_id, CASE WHEN is_active AND posted_at < DATE '1998-01-01' - 14 THEN FALSE
    WHEN job_id IN (SELECT job_id FROM hits) THEN FALSE ELSE is_active END AS is_active FROM jobs"""))
def expire_postings(spark, folder):
    expired = P.expire(S.jobs(spark, folder), fetched(spark, folder), "1998-01-01")
    return expired.jobs.select("job_id", "is_active")


@query("expire_counts", S.on_jobs(EXPIRE_SQL + """
  SELECT count(*) FILTER (is_active AND posted_at < DATE '1998-01-01' - 14) AS expired_by_age,
    count(*) FILTER (is_active AND posted_at >= DATE '1998-01-01' - 14) AS tested,
    (SELECT count(*) FROM hits) AS expired_by_link FROM jobs"""))
def expire_counts(spark, folder):
    return P.expire(S.jobs(spark, folder), fetched(spark, folder), "1998-01-01").stats
