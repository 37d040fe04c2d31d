"""The incremental load gives what the whole load gives, and nothing twice."""

from datetime import date, datetime

from pyspark.sql import functions as F

from garimpo.plans.silver import load
from garimpo.schemas import RAW_JOBS
from garimpo.sources import envelopes as E
from garimpo.streaming.landing import load_new_files, raw_table


def day(spark, number, ids):
    at = datetime(2026, 6, number)
    rows = [("jooble", date(2026, 6, number), at, f'{{"id": {i}, "title": "t{i}"}}') for i in ids]
    rows.append(("jooble", date(2026, 6, number), at, f'{{"title": "no id {number}"}}'))
    return spark.createDataFrame(rows, E.ROW_SCHEMA)


def test_new_files_only(spark, tmp_path):
    landing, raw, state = (str(tmp_path / n) for n in ("landing", "raw", "state"))

    def seen():
        return sorted((r["title"], str(r["ingested_at"])) for r in raw_table(spark, raw).collect())

    E.write_landing(day(spark, 1, [1, 2]), landing)
    load_new_files(spark, landing, raw, state)
    assert len(seen()) == 3
    E.write_landing(day(spark, 2, [2, 3]), landing)
    load_new_files(spark, landing, raw, state)
    twice = seen()
    load_new_files(spark, landing, raw, state)
    assert seen() == twice and [t for t, _ in twice] == ["no id 1", "no id 2", "t1", "t2", "t3"]

    records = E.read_landing(spark, landing).withColumn("ingested_at", F.col("extracted_at"))
    whole = load(records, spark.createDataFrame([], RAW_JOBS)).raw
    assert sorted((r["title"], str(r["ingested_at"])) for r in whole.collect()) == twice
