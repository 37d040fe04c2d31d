"""Landing, source mapping, cards and tables."""

import base64
import json
from datetime import date, datetime

from pyspark.sql import functions as F

from garimpo.plans import silver as P
from garimpo.schemas import JOBS, RAW_JOBS
from garimpo.sources import cards as C
from garimpo.sources import envelopes as E
from garimpo.sources import tables as T
from garimpo.sources.mapping import as_date_value, as_flag, as_id, map_all, nested


def parsed(evaluate, build, documents):
    return evaluate(lambda: build(F.try_parse_json("j")), [(json.dumps(d),) for d in documents], "j string")


def test_nested(evaluate):
    whole = {"company": {"display_name": "Nubank", "details": {"size": "Large"}}}
    assert parsed(evaluate, lambda d: nested(d, "company.display_name"), [whole]) == ["Nubank"]
    assert parsed(evaluate, lambda d: nested(d, "company.details.size"), [whole]) == ["Large"]
    assert parsed(evaluate, lambda d: nested(d, "company.display_name"),
                  [{"company": {"name": "x"}}, {"company": "Nubank"}, {}, []]) == [None] * 4


def test_nested_types(evaluate):
    assert parsed(evaluate, lambda d: as_id(nested(d, "v", "variant")),
                  [{"v": 12}, {"v": "12"}, {"v": 0}, {"v": ""}, {"v": None}, {}, {"v": False}]) == [
        "12", "12", None, None, None, None, None]
    assert parsed(evaluate, lambda d: as_flag(nested(d, "v", "variant")),
                  [{"v": True}, {"v": False}, {"v": "Home Office"}, {"v": "remoto"}, {"v": "hybrid"}, {"v": "true"}]) == [
        True, False, True, True, False, False]
    assert parsed(evaluate, lambda d: as_date_value(nested(d, "v", "variant")),
                  [{"v": 1779926400}, {"v": 1779926400.0}, {"v": "2026-06-03T15:30:00.123Z"}, {"v": "20/05/2026"},
                   {"v": 0}, {"v": ""}, {"v": "x"}, {"v": []}, {}]) == [
        date(2026, 5, 28), date(2026, 5, 28), date(2026, 6, 3), date(2026, 5, 20), None, None, None, None, None]


POSTINGS = [
    ("adzuna", {"id": "adz-123", "title": "Engenheiro de Dados Pleno", "company": {"display_name": "Stark Industries"},
                "location": {"display_name": "São Paulo, SP"}, "description": "pipelines e ETL.",
                "redirect_url": "https://x.com/job/123", "created": "2026-06-01T12:00:00Z"}),
    ("remoteok", {"id": "ro-555", "position": "Data Engineer", "company": "GitLab", "location": "Worldwide",
                  "description": "d", "url": "https://x.com/555", "date": 1779926400}),
    ("adzuna", {"id": 999, "title": "Analista de Dados (Home Office)", "company": {"display_name": "ACME Corp"},
                "location": {"display_name": "SP"}, "description": "x", "created": "2026-06-01"}),
    ("jooble", {"id": 7, "title": "BI", "company": "A", "location": "B", "snippet": "s", "link": "l",
                "updated": "01/06/2026"}),
    ("gupy", {"source_id": "g1", "title": "BI", "company": "A", "location": "B", "raw_text": "s", "url": "l",
              "posted_at": "2026-06-01T10:00:00.5", "is_remote": "remote"}),
]


def landed(spark):
    at = datetime(2026, 6, 2)
    return spark.createDataFrame(
        [(s, date(2026, 6, 2), at, json.dumps(d, ensure_ascii=False)) for s, d in POSTINGS], E.ROW_SCHEMA)


def test_map_all_and_load(spark):
    rows = {r["source_id"]: r for r in map_all(landed(spark)).collect()}
    stark = rows["adz-123"]
    assert (stark["company"], stark["location"], stark["posted_at"], stark["is_remote"]) == (
        "Stark Industries", "São Paulo, SP", date(2026, 6, 1), False)
    assert stark["url"] == "https://x.com/job/123" and json.loads(stark["payload"]) == POSTINGS[0][1]
    assert rows["ro-555"]["is_remote"] and rows["ro-555"]["posted_at"] == date(2026, 5, 28)
    assert rows["999"]["is_remote"] and rows["g1"]["is_remote"] and not rows["7"]["is_remote"]
    assert rows["7"]["description"] == "s" and rows["7"]["posted_at"] == date(2026, 6, 1)

    empty = spark.createDataFrame([], RAW_JOBS)
    records = landed(spark).withColumn("ingested_at", F.col("extracted_at"))
    run = P.load(records, empty)
    assert P.load_totals(run.per_source).collect()[0].asDict() == {
        "adzuna": 2, "jooble": 1, "remoteok": 1, "gupy": 1, "total": 5}
    again = P.load(records, run.raw)
    assert P.load_totals(again.per_source).collect()[0]["total"] == 0
    assert again.raw.count() == 5


def test_postings_without_id_stay_apart(spark):
    row = ("jooble", date(2026, 6, 2), datetime(2026, 6, 2), '{"title": "same"}')
    records = spark.createDataFrame([row, row], E.ROW_SCHEMA).withColumn("ingested_at", F.col("extracted_at"))
    raw = P.load(records, spark.createDataFrame([], RAW_JOBS)).raw
    assert raw.select("id").distinct().count() == 2
    assert P.load(records, raw).raw.select("id").distinct().count() == 4


def test_landing_round_trip(spark, tmp_path):
    root = str(tmp_path / "landing")
    assert E.read_landing(spark, root).count() == 0
    E.write_landing(landed(spark), root)
    E.write_landing(landed(spark).filter("source = 'gupy'"), root)  # only that day is replaced
    assert E.read_landing(spark, root).count() == 5
    one = E.read_landing(spark, root, "adzuna", "2026-06-02")
    assert one.count() == 2 and "PartitionFilters: [isnotnull" in one._jdf.queryExecution().toString()
    heads = {r["source"]: r["total_results"] for r in E.manifest(E.read_landing(spark, root)).collect()}
    assert heads == {"adzuna": 2, "jooble": 1, "remoteok": 1, "gupy": 1}


def test_exchange_document(spark, tmp_path):
    folder = tmp_path / "gupy" / "2026-06-02"
    folder.mkdir(parents=True)
    document = {"source": "gupy", "total_results": 2, "results": [POSTINGS[4][1], {"source_id": "g2", "title": "x"}]}
    (folder / E.EXCHANGE_FILE).write_text(json.dumps(document, indent=2, ensure_ascii=False))
    rows = E.read_exchange(spark, str(tmp_path), "gupy", "2026-06-02")
    assert sorted(r["source_id"] for r in map_all(rows).collect()) == ["g1", "g2"]
    assert E.read_exchange(spark, str(tmp_path), "gupy", "2026-06-03").count() == 0


def token(value):
    return base64.b64encode(json.dumps(value).encode()).decode().rstrip("=")


def test_cards(spark):
    base = "https://x.gupy.io/job/"
    rows = [
        ("a", " Nubank \n\n Data Engineer\nRemoto - Brasil\nmore", "/job/" + token({"jobId": 123, "s": "x"})),
        ("b", "only\ntwo", base + "plain-token?x=1"), ("c", "a\nb\nHOME OFFICE", base + token({"other": 1})),
        ("d", "a\nb\nc", base + token([1])), ("e", "a\nb\nc", "https://x.gupy.io/about"), ("f", "a\nb\nc", None),
    ]
    found = {r["k"]: r for r in C.parse_cards(spark.createDataFrame(rows, "k string, raw_text string, url string")).collect()}
    assert (found["a"]["company"], found["a"]["title"], found["a"]["location"]) == (
        "Nubank", "Data Engineer", "Remoto - Brasil")
    assert found["a"]["url"].startswith("https://portal.gupy.io/job/") and found["a"]["source_id"] == "123"
    assert found["a"]["is_remote"] and found["c"]["is_remote"] and not found["d"]["is_remote"]
    assert found["b"]["company"] is None and found["b"]["lines"] == ["only", "two"]
    assert [found[k]["source_id"] for k in "bcdef"] == ["plain-token", None, token([1]), None, None]


def test_feed_and_caps(spark):
    feed = spark.createDataFrame([(1, ["meta", "a", "b"]), (2, [])], "k int, items array<string>")
    head, rows = E.split_feed(feed)
    assert [r["item"] for r in head.collect()] == ["meta"]
    assert [(r["pos"], r["item"]) for r in rows.collect()] == [(1, "a"), (2, "b")]
    capped = E.cap_per_term(spark.range(200).withColumn("term", F.lit("t")), "term", [F.col("id")], 50)
    assert capped.count() == 50
    union = E.tagged_union({"x": spark.range(2), "y": spark.range(2).withColumn("v", F.lit(1))})
    assert union.count() == 4 and union.filter("search_term = 'x' and v is null").count() == 2


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    for form in T.FORMATS:
        path = T.write_table(df, str(tmp_path / form), "t", form=form)
        T.append_table(df, path, form)
        assert T.read_table(spark, path, "k string, n int", form).count() == 4
    stored = T.materialise({"stg": df, "model": df}, str(tmp_path / "m"), views=["stg"])
    assert spark.sql("select count(*) c from model join stg using (k)").collect()[0]["c"] == 2
    assert stored["stg"] is df


def test_label_and_expiry_steps(spark):
    day = date(2026, 5, 20)

    def job(i, posted, url, active=True, area="unknown", source="unknown"):
        return (i, [i], i, "t", "c", "l", area, "unknown", ["SQL"], url, posted, False, False,
                datetime(2026, 5, 1), active, source)

    jobs = spark.createDataFrame([
        job("1", day, "u"), job("2", day, ""), job("3", date(2026, 5, 1), "u"), job("4", None, "u"),
        job("5", day, "u", active=False), job("6", day, "u", area="bi", source="syntax"), job("7", day, "u"),
    ], JOBS)
    answers = spark.createDataFrame([
        ("1", '{"area": "bi", "seniority": "x"}'), ("7", "{}"), ("2", None), ("6", '{"area": "bi"}'),
    ], "job_id string, response string")
    labelled = P.apply_labels(jobs, answers, "2026-05-21")
    assert labelled.stats.collect()[0].asDict() == {"processed": 3, "success": 1, "failed": 2}
    one = labelled.jobs.filter("job_id = '1'").collect()[0]
    assert (one["area"], one["seniority"], one["classification_source"], one["skills"]) == ("bi", "unknown", "ia", ["SQL"])
    pages = spark.createDataFrame(
        [(i, 404, "u", "", None) for i in ("1", "2", "3", "4", "5")] + [("7", 200, "u", "aberta", None)],
        "job_id string, status_code int, final_url string, html string, error string")
    expired = P.expire(jobs, pages, "2026-05-21")
    assert expired.stats.collect()[0].asDict() == {"expired_by_age": 1, "tested": 4, "expired_by_link": 1}
    assert sorted(r["job_id"] for r in expired.jobs.filter("not is_active").collect()) == ["1", "3", "5"]
