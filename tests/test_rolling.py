"""Windows as sums of stored days equal the full rebuild, and a new day reads that day only."""

import os
from datetime import date, timedelta
from pathlib import Path

from garimpo.plans import gold as G
from garimpo.plans import rolling as W

SCHEMA = "job_id string, posted_date date, area_code string, seniority_code string, is_remote boolean"


def rows(df):
    return sorted(map(str, df.collect()))


def fact(spark, first, last):
    start = date(2026, 3, 1)
    data = [
        (f"{d}-{i}", start + timedelta(d), "bi" if i % 3 else None, "senior" if d % 2 else "junior", [True, False, None][i % 3])
        for d in range(first, last) for i in range(1 + d % 4)
    ]
    return spark.createDataFrame([*data, ("none", None, "bi", "junior", True)], SCHEMA)


def test_sums_of_days_equal_the_rebuild(spark, tmp_path):
    path, whole = str(tmp_path / "days"), fact(spark, 0, 60)
    W.refresh(fact(spark, 0, 50), "overview", path)
    stamps = {p: p.stat().st_mtime_ns for p in Path(path).glob("_unit=*")}
    W.refresh(whole, "overview", path, "2026-04-18")  # day 48: two known days anew, ten more
    untouched = [p for p in stamps if p.name < "_unit=2026-04-18"]
    assert len(untouched) == 48 and all(p.stat().st_mtime_ns == stamps[p] for p in untouched)
    for as_of in ("2026-04-29", "2026-04-02", "2026-06-30"):
        got = W.market_overview(W.window(spark, path, 30, as_of), as_of)
        want = G.agg_market_overview(whole, as_of)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_other_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "days")
    W.refresh(fact(spark, 0, 40), "overview", path)
    held = W.window(spark, path, 2, "2026-04-09")
    assert 0 < len(held.inputFiles()) and len({r["posted_date"] for r in held.collect()}) == 3
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_unit" in plan and ">= 2026-04-07" in plan
    source = fact(spark, 0, 40)
    source.write.parquet(str(tmp_path / "fact"))
    before = spark.read.parquet(str(tmp_path / "fact"))
    read = W.overview_days(before.filter("posted_date >= date'2026-04-09'"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(posted_date), GreaterThanOrEqual(posted_date,2026-04-09)]" in read


def test_months_as_units(spark, tmp_path):
    path, whole = str(tmp_path / "days"), fact(spark, 0, 60)
    W.refresh(fact(spark, 0, 50), "overview", path, unit="month")
    W.refresh(whole, "overview", path, "2026-04-18", unit="month")
    assert {p for p in os.listdir(path) if p.startswith("_unit")} == {"_unit=2026-03-01", "_unit=2026-04-01"}
    got = W.market_overview(W.window(spark, path, 30, "2026-04-29", "month"), "2026-04-29")
    assert rows(got) == rows(G.agg_market_overview(whole, "2026-04-29"))
