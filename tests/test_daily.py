"""The fact by load day: touched days only, replaced keys, refused schema changes."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from garimpo.operators.merge import incremental
from garimpo.sources import daily as D

SCHEMA = "k string, mark timestamp, v string"


def at(day, hour=1):
    return datetime(2026, 5, day, hour)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def days_of(path):
    return {p.name.split("=")[1]: p.stat().st_mtime_ns for p in Path(path).glob("load_day=*")}


@pytest.fixture
def table(spark, tmp_path):
    held = [("a", at(1), "old"), ("b", at(1, 2), "old"), ("c", at(2), "old"), ("d", at(3), "old"), ("e", None, "old")]
    path = str(tmp_path / "fact")
    D.write_days(spark.createDataFrame(held, SCHEMA), path, "mark")
    return path, held


def test_load_replaces_keys_in_touched_days(spark, table):
    path, held = table
    before = days_of(path)
    new = spark.createDataFrame(
        [("c", at(4), "new"), ("a", at(3, 5), "new"), ("f", at(5), "new"), ("g", at(2), "late"), ("h", None, "no mark")], SCHEMA
    )
    want = rows(incremental(spark.createDataFrame(held, SCHEMA), new, "k", "mark"))
    days = D.load_days(new, path, "k", "mark")
    assert [d.day for d in days] == [1, 2, 3, 4, 5]
    assert rows(D.read_days(spark, path)) == want
    after = days_of(path)
    assert set(after) == {"2026-05-01", "2026-05-03", "2026-05-04", "2026-05-05", "__HIVE_DEFAULT_PARTITION__"}  # day 2 is empty
    assert after["__HIVE_DEFAULT_PARTITION__"] == before["__HIVE_DEFAULT_PARTITION__"]
    assert D.load_days(new, path, "k", "mark") == []
    assert rows(D.read_days(spark, path)) == want


def test_untouched_days_are_not_written(spark, table):
    path, _ = table
    before = days_of(path)
    D.load_days(spark.createDataFrame([("d", at(6), "new")], SCHEMA), path, "k", "mark")
    after = days_of(path)
    assert [after[d] for d in ("2026-05-01", "2026-05-02")] == [before[d] for d in ("2026-05-01", "2026-05-02")]
    assert "2026-05-03" not in after and "2026-05-06" in after


def test_plan_reads_touched_days_and_the_newest_only(spark, table):
    path, _ = table
    fact = spark.read.parquet(path)
    plan = fact.filter(D.in_days([at(2).date(), None]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert D.newest_day(spark, path) == "2026-05-03"
    above = D.above_stored_mark(fact, fact, "mark", "2026-05-03")
    assert "DataFilters: [isnotnull(mark" in above._jdf.queryExecution().executedPlan().toString()
    assert above.count() == 0


def test_key_without_mark_is_replaced(spark, table):
    path, _ = table
    D.load_days(spark.createDataFrame([("e", at(7), "new")], SCHEMA), path, "k", "mark")
    assert ("e", at(7), "new") in rows(D.read_days(spark, path))
    assert "__HIVE_DEFAULT_PARTITION__" not in days_of(path)


def test_schema_changes_are_refused(spark, table):
    path, held = table
    new = spark.createDataFrame([("z", at(9), "new")], SCHEMA)
    for changed in (new.drop("v"), new.withColumn("w", F.lit(1)), new.select("v", "mark", "k"), new.withColumn("v", F.lit(1))):
        with pytest.raises(ValueError, match="schema changed"):
            D.load_days(changed, path, "k", "mark")
    assert rows(D.read_days(spark, path)) == rows(spark.createDataFrame(held, SCHEMA))


def test_months_as_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    held = spark.createDataFrame([("a", at(1), "old"), ("b", datetime(2026, 4, 9), "old")], SCHEMA)
    D.write_days(held, path, "mark", "month")
    new = spark.createDataFrame([("b", at(20), "new"), ("c", datetime(2026, 6, 2), "new")], SCHEMA)
    want = rows(incremental(held, new, "k", "mark"))
    D.load_days(new, path, "k", "mark", "month")
    assert rows(D.read_days(spark, path)) == want and set(days_of(path)) == {"2026-05-01", "2026-06-01"}
