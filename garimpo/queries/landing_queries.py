"""Landing, source mapping and card parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.dates import parse_date
from ..plans import gold as G
from ..plans import silver as P
from ..schemas import RAW_JOBS
from ..session import checkpoint, shared_folder
from ..sources import cards as C
from ..sources import envelopes as E
from ..sources import tables as T
from ..sources.mapping import as_id, map_all, nested
from . import stand_ins as S
from .registry import query, table, texts


def posting_records(spark, folder):
    """Events as JSON postings in the four source layouts."""
    kind, stamp = F.col("event_type"), F.col("ts").cast("timestamp")
    title = F.when(F.col("value") > 30, F.concat(F.lit("Remote "), kind)).otherwise(kind).alias("title")
    user = F.concat(F.lit("User "), F.col("user_id"))
    place, text = F.concat(F.lit("Place "), kind), F.col("props")
    link = F.concat(F.lit("https://e.example.com/"), F.col("event_id"))
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    adzuna = F.struct(
        F.col("event_id").alias("id"), title,
        F.struct(user.alias("display_name")).alias("company"),
        F.struct(place.alias("display_name")).alias("location"),
        text.alias("description"), link.alias("redirect_url"), iso.alias("created"),
    )
    jooble = F.struct(
        F.col("event_id").cast("string").alias("id"), title, user.alias("company"), place.alias("location"),
        text.alias("snippet"), link.alias("link"), F.date_format(stamp, "dd/MM/yyyy").alias("updated"),
    )
    remoteok = F.struct(
        F.when(F.col("value") >= 5, F.col("event_id")).alias("id"), title.alias("position"),
        user.alias("company"), place.alias("location"), text.alias("description"), link.alias("url"),
        F.unix_seconds(stamp).alias("date"),
    )
    gupy = F.struct(
        F.col("event_id").cast("string").alias("source_id"), title, user.alias("company"),
        place.alias("location"), text.alias("raw_text"), link.alias("url"),
        F.date_format(stamp, "yyyy-MM-dd").alias("posted_at"), (F.col("value") > 10).alias("is_remote"),
    )
    chosen = (
        F.when(kind == "view", F.to_json(adzuna)).when(kind == "click", F.to_json(jooble))
        .when(kind == "signup", F.to_json(remoteok)).otherwise(F.to_json(gupy))
    )
    source = (
        F.when(kind == "view", "adzuna").when(kind == "click", "jooble")
        .when(kind == "signup", "remoteok").otherwise("gupy")
    )
    events = texts(spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return events.select(
        source.alias("source"), stamp.cast("date").alias("ds"), stamp.alias("extracted_at"),
        stamp.alias("ingested_at"), chosen.alias("payload"),
    )


MAPPED = """
mapped AS (
  SELECT event_id, ts, event_type, value,
    CASE event_type WHEN 'view' THEN 'adzuna' WHEN 'click' THEN 'jooble' WHEN 'signup' THEN 'remoteok' ELSE 'gupy' END AS source,
    CASE WHEN event_type = 'signup' AND NOT value >= 5 THEN NULL
         WHEN event_type IN ('view', 'signup') AND event_id = 0 THEN NULL
         ELSE CAST(event_id AS VARCHAR) END AS source_id,
    CASE WHEN value > 30 THEN 'Remote ' || event_type ELSE event_type END AS title,
    'User ' || user_id AS company, 'Place ' || event_type AS location, props AS description,
    'https://e.example.com/' || event_id AS url, CAST(ts AS DATE) AS posted_at,
    event_type = 'signup' OR value > 30 OR (event_type IN ('purchase', 'error') AND value > 10) AS is_remote
  FROM events)"""


@query("field_map_json", f"""
  WITH {MAPPED} SELECT source, source_id, title, company, location, description, url, posted_at, is_remote
  FROM mapped""")
def field_map_json(spark, folder):
    return map_all(posting_records(spark, folder)).select(
        "source", "source_id", "title", "company", "location", "description", "url", "posted_at", "is_remote"
    )


@query("nested_paths", """
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, NULL::VARCHAR AS missing,
    NULL::VARCHAR AS below_value, CASE WHEN json_extract_string(props, '$.k') <> '0'
      THEN json_extract_string(props, '$.k') END AS as_id
  FROM events""")
def nested_paths(spark, folder):
    """A present path, a missing one, and one below a value that is no object."""
    parsed = table(spark, folder, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    doc = F.col("doc")
    return parsed.select(
        "event_id", nested(doc, "k").alias("k"), nested(doc, "a.b").alias("missing"),
        nested(doc, "k.x").alias("below_value"), as_id(nested(doc, "k", "variant")).alias("as_id"),
    )


@query("load_counts", f"""
  WITH {MAPPED}, known AS (SELECT * FROM mapped WHERE value < 20),
  fresh AS (
    SELECT source FROM mapped m WHERE source_id IS NULL OR NOT EXISTS (
      SELECT 1 FROM known k WHERE k.source = m.source AND k.source_id = m.source_id))
  SELECT count(*) FILTER (source = 'adzuna') AS adzuna, count(*) FILTER (source = 'jooble') AS jooble,
    count(*) FILTER (source = 'remoteok') AS remoteok, count(*) FILTER (source = 'gupy') AS gupy,
    count(*) AS total FROM fresh""")
def load_counts(spark, folder):
    """All postings land again; those with a small value are already loaded."""
    records = posting_records(spark, folder)
    known_ids = table(spark, folder, "events").filter("value < 20").select(
        F.concat(F.lit("https://e.example.com/"), F.col("event_id")).alias("url")
    )
    raw = map_all(records).join(known_ids, "url", "left_semi")
    raw = checkpoint(raw.select([f.split()[0] for f in RAW_JOBS.replace("\n", " ").split(",")]))
    return P.load_totals(P.load(records, raw).per_source)


@query("envelope_roundtrip", """
  SELECT CASE event_type WHEN 'view' THEN 'adzuna' WHEN 'click' THEN 'jooble' WHEN 'signup' THEN 'remoteok'
      ELSE 'gupy' END AS source, CAST(ts AS DATE) AS ds,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS extracted_at, count(*) AS total_results
  FROM events GROUP BY 1, 2""")
def envelope_roundtrip(spark, folder):
    """Write all postings, write them again, read the landing zone and describe it."""
    root = shared_folder(spark, "landing")
    rows = posting_records(spark, folder).select("source", "ds", "extracted_at", "payload")
    E.write_landing(rows, root)
    E.write_landing(rows, root)
    described = E.manifest(E.read_landing(spark, root))
    return described.withColumn("extracted_at", F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss"))


@query("landing_partition", """
  SELECT CAST(event_id AS VARCHAR) AS event_id FROM events
  WHERE event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-15'""")
def landing_partition(spark, folder):
    """One source and day of the landing zone; a day that never landed is empty."""
    root = shared_folder(spark, "landing")
    E.write_landing(posting_records(spark, folder).select("source", "ds", "extracted_at", "payload"), root)
    day = E.read_landing(spark, root, "jooble", "2024-01-15")
    never = E.read_landing(spark, root, "jooble", "1999-01-01").unionByName(
        E.read_landing(spark, f"{root}-missing")
    )
    return day.unionByName(never).select(nested(F.try_parse_json("payload"), "id").alias("event_id"))


@query("per_term_cap", """
  SELECT event_type AS term, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
  WHERE rn <= 50""")
def per_term_cap(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_type").alias("term"), "ts", "event_id")
    return E.cap_per_term(rows, "term", [F.col("ts"), F.col("event_id")], V.TERM_CAP).select("term", "event_id")


@query("split_feed", r"""
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, CASE WHEN i = 1 THEN 'metadata' ELSE 'row' END AS kind,
    items[i] AS item
  FROM (SELECT doc_id, string_split(text, chr(10)) AS items, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents)""")
def split_feed(spark, folder):
    """The lines of a document as a feed: the first one is metadata."""
    feeds = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("items"))
    head, rows = E.split_feed(feeds)
    return (
        head.select("doc_id", F.lit(0).alias("pos"), F.lit("metadata").alias("kind"), "item")
        .unionByName(rows.select("doc_id", "pos", F.lit("row").alias("kind"), "item"))
    )


@query("tagged_union", """
  SELECT 'big' AS search_term, event_id, value FROM events WHERE value > 10
  UNION ALL SELECT 'click', event_id, NULL FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'view', event_id, value FROM events WHERE event_type = 'view'""")
def tagged_union(spark, folder):
    """Overlapping result pages; a page without a column gets NULL there."""
    events = table(spark, folder, "events").select("event_id", "value", "event_type")
    return E.tagged_union({
        "big": events.filter("value > 10").drop("event_type"),
        "click": events.filter("event_type = 'click'").select("event_id"),
        "view": events.filter("event_type = 'view'").drop("event_type"),
    })


@query("card_parse", r"""
  SELECT doc_id, lines[1] AS company, lines[2] AS title, lines[3] AS location,
    len(lines) AS line_count, 'https://portal.gupy.io' || path AS url, source_id
  FROM (
    SELECT doc_id, CASE WHEN len(all_lines) >= 3 THEN all_lines ELSE all_lines[1:0] END AS lines_or_none,
      all_lines, CASE WHEN len(all_lines) >= 3 THEN all_lines END AS three, path, source_id,
      all_lines AS lines0
    FROM (
      SELECT doc_id,
        list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(160))),
          lambda x: x <> '') AS all_lines,
        CASE lang WHEN 'en' THEN '/job/' || to_base64(encode('{"jobId":' || doc_id || '}'))
                  WHEN 'fr' THEN '/job/tok-' || doc_id
                  WHEN 'de' THEN '/job/' || to_base64(encode('{"other":' || doc_id || '}'))
                  ELSE '/other/' || doc_id END AS path,
        CASE lang WHEN 'en' THEN CASE WHEN doc_id <> 0 THEN CAST(doc_id AS VARCHAR) END
                  WHEN 'fr' THEN 'tok-' || doc_id END AS source_id
      FROM documents)) t,
    LATERAL (SELECT CASE WHEN len(t.all_lines) >= 3 THEN t.all_lines ELSE NULL END AS lines)""".replace(
        "len(lines) AS line_count", "CAST(len(all_lines) AS INTEGER) AS line_count"))
def card_parse(spark, folder):
    """Documents as card texts; the link's token holds the id, hides it, or is the id."""
    lang, doc = F.col("lang"), F.col("doc_id")
    url = (
        F.when(lang == "en", F.concat(F.lit("/job/"), F.base64(F.to_json(F.struct(doc.alias("jobId"))).cast("binary"))))
        .when(lang == "fr", F.concat(F.lit("/job/tok-"), doc))
        .when(lang == "de", F.concat(F.lit("/job/"), F.base64(F.to_json(F.struct(doc.alias("other"))).cast("binary"))))
        .otherwise(F.concat(F.lit("/other/"), doc))
    )
    cards = table(spark, folder, "documents").select("doc_id", F.col("text").alias("raw_text"), url.alias("url"))
    return C.parse_cards(cards).select(
        "doc_id", "company", "title", "location", F.size("lines").alias("line_count"), "url", "source_id"
    )


@query("url_token_id", r"""
  SELECT page_id, nullif(regexp_extract(url, '/en/([^/?#]+)', 1), '') AS token,
    'https://portal.gupy.io' || regexp_extract(url, '://[^/]+(.*)', 1) AS absolute
  FROM pages""")
def url_token_id(spark, folder):
    path = F.regexp_extract("url", "://[^/]+(.*)", 1)
    return table(spark, folder, "pages").select(
        "page_id", C.token_id(C.url_token(F.col("url"), "en")).alias("token"),
        C.absolute_url(path).alias("absolute"),
    )


@query("parse_dates", """
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE) END AS parsed
  FROM orders""")
def parse_dates(spark, folder):
    """Order dates written in every known format, and one that is none."""
    stamp, form = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(form == "1-URGENT", F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == "2-HIGH", F.date_format(stamp, "yyyy-MM-dd"))
        .when(form == "3-MEDIUM", F.date_format(stamp, "d/M/yyyy"))
        .when(form == "4-NOT SPECIFIED", F.date_format(stamp, "MMM d yyyy"))
        .otherwise(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    )
    return table(spark, folder, "orders").select("o_orderkey", parse_date(text).alias("parsed"))


@query("materialise", S.on_gold("""
  SELECT 'fact_job_posting' AS model, count(*) AS n FROM fact
  UNION ALL SELECT 'dim_company', count(*) FROM dim_company
  UNION ALL SELECT 'dim_location', count(*) FROM dim_location
  UNION ALL SELECT 'agg_skills_frequency', count(*) FROM skills_frequency
  UNION ALL SELECT 'stg_jobs', count(*) FROM stg_jobs"""))
def materialise(spark, folder):
    """Staging as views over stored silver tables, everything else written and read back by name."""
    root = shared_folder(spark, "gold")
    keep = T.stored_in(root)
    silver = {name: keep(df, name) for name, df in S.silver(spark, folder).items()}
    stored = T.materialise(lambda held: G.build_gold(spark, silver, S.JOBS_AS_OF, held), root, views=G.STAGING)
    names = ["fact_job_posting", "dim_company", "dim_location", "agg_skills_frequency", "stg_jobs"]
    assert set(names) <= set(stored)
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS n FROM {n}" for n in names))
