"""Keys, dates and ids that must not depend on the session or on a rerun."""

import datetime

from pyspark.sql import functions as F

from garimpo.functions.dates import epoch_date
from garimpo.functions.keys import lookup_key
from garimpo.plans.silver import load
from garimpo.schemas import RAW_JOBS
from garimpo.sources import envelopes as E
from garimpo.sources.mapping import with_own_ids


def test_epoch_dates_are_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            rows = spark.createDataFrame([(1704070800.0,), (-1.0,), (0.0,), (None,)], "s double")
            got = [r[0] for r in rows.select(epoch_date(F.col("s"))).collect()]
            assert got == [datetime.date(2024, 1, 1), datetime.date(1969, 12, 31), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_name_keys_lose_all_white_space(evaluate):
    names = [("Acme\t",), ("\u00a0acme",), (" ACME\r\n",), ("acme",)]
    assert set(evaluate(lambda: lookup_key(F.col("n")), names, "n string")) == {"acme"}


def test_own_ids_repeat_with_the_load(spark):
    rows = [("gupy", None, "{}", "2024-01-01", "a"), ("gupy", None, "{}", "2024-01-01", "a"), ("gupy", "7", "{}", "2024-01-01", "b")]
    df = spark.createDataFrame(rows, "source string, source_id string, payload string, ingested_at string, id string").coalesce(1)
    first, second = ([r.id for r in with_own_ids(df, 1).collect()] for _ in range(2))
    third = [r.id for r in with_own_ids(df, 2).collect()]
    assert first == second and not set(first[:2]) & set(third) and len(set(first)) == 3 and first[2] == "b"


def test_own_ids_do_not_depend_on_cores_or_splits(spark, tmp_path):
    day = datetime.date(2026, 6, 2)
    at = datetime.datetime(2026, 6, 2)
    rows = [("jooble", day, at, f'{{"title": "t{i % 40}"}}') for i in range(400)]
    root = str(tmp_path / "landing")
    E.write_landing(spark.createDataFrame(rows, E.ROW_SCHEMA).repartition(3), root)
    empty = spark.createDataFrame([], RAW_JOBS)

    def ids(raw, parts=None, size="128m", with_place=True):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            records = E.read_landing(spark, root, with_place=with_place).withColumn("ingested_at", F.col("extracted_at"))
            loaded = load(records if parts is None else records.repartition(parts), raw, run=7)
            return sorted(r["id"] for r in loaded.raw.select("id").collect()), loaded
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")

    for with_place in (True, False):
        first, loaded = ids(empty, with_place=with_place)
        assert len(set(first)) == 400
        assert ids(empty, size="2k", with_place=with_place)[0] == first
        assert ids(empty, parts=8, with_place=with_place)[0] == ids(empty, parts=2, with_place=with_place)[0] == first
        held = spark.createDataFrame(loaded.raw.collect(), RAW_JOBS)
        again, second = ids(held, parts=5, with_place=with_place)  # the run is repeated after success
        assert again == first and second.per_source.count() == 0
