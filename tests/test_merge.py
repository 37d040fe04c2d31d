"""Keyed merges: results, and that a second run changes nothing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from garimpo.operators import lookups as L
from garimpo.operators import merge as M
from garimpo.plans import runs as R
from garimpo.schemas import RUN_LOG


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


RAW = "id string, source string, source_id string, n int"


def test_insert_if_absent(spark):
    target = frame(spark, [("a", "s", "1", 0)], RAW)
    batch = frame(spark, [("b", "s", "1", 1), ("c", "s", "2", 2), ("d", "s", "2", 3), ("e", "t", "1", 4),
                          ("f", "s", None, 5), ("g", "s", None, 6)], RAW)
    args = (["source", "source_id"], [F.col("n")], "source_id")
    merged = M.insert_if_absent(target, batch, *args)
    assert [r[0] for r in rows(merged)] == ["a", "c", "e", "f", "g"]
    assert M.new_rows(target, batch, *args).count() == 4
    keyed = batch.filter("source_id is not null")
    once = M.insert_if_absent(target, keyed, *args)
    assert rows(M.insert_if_absent(once, keyed, *args)) == rows(once)


def test_a_dominant_key_is_cut_before_the_shuffle(spark):
    many = spark.range(1000).select(F.lit("s").alias("source"), (F.col("id") % 2).alias("source_id"), "id")
    plan = M.first_per_key(many, ["source", "source_id"], [F.col("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_update_by_key(spark):
    target = frame(spark, [("1", "a", 1), ("2", "b", 2)], "k string, v string, n int")
    changes = frame(spark, [("2", None), ("3", "x")], "k string, v string")
    updated = M.update_by_key(target, changes, "k", ["v"])
    assert rows(updated) == [("1", "a", 1), ("2", None, 2)]
    assert rows(M.update_by_key(updated, changes, "k", ["v"])) == rows(updated)


def test_set_by_ids_and_where(spark):
    target = frame(spark, [("1", True), ("2", True), ("3", None)], "k string, on boolean")
    ids = frame(spark, [("2",), ("2",), ("9",)], "k string")
    assert rows(M.set_by_ids(target, ids, "k", {"on": F.lit(False)})) == [("1", True), ("2", False), ("3", None)]
    assert rows(M.set_where(target, F.col("k") == "1", {"on": F.lit(False)})) == [
        ("1", False), ("2", True), ("3", None)]


def test_append_to_array(spark):
    target = frame(spark, [("1", ["a"]), ("2", []), ("3", None), ("4", ["z"])], "k string, ids array<string>")
    more = frame(spark, [("1", "c", 1), ("1", "b", 2), ("1", "a", 3), ("1", "b", 4), ("2", "x", 1),
                         ("2", None, 2), ("3", "y", 1)], "k string, item string, n int")
    merged = M.append_to_array(target, more, "k", "ids", "item", "n")
    assert rows(merged) == [("1", ["a", "c", "b"]), ("2", ["x"]), ("3", None), ("4", ["z"])]
    assert rows(M.append_to_array(merged, more, "k", "ids", "item", "n")) == rows(merged)


def test_incremental(spark):
    schema = "k string, mark int, v string"
    target = frame(spark, [("1", 5, "old"), ("2", 7, "old")], schema)
    new = frame(spark, [("1", 9, "new"), ("2", 7, "late"), ("3", 8, "new"), ("4", 1, "late")], schema)
    loaded = M.incremental(target, new, "k", "mark")
    assert rows(loaded) == [("1", 9, "new"), ("2", 7, "old"), ("3", 8, "new")]
    assert rows(M.incremental(loaded, new, "k", "mark")) == rows(loaded)
    assert rows(M.incremental(target, new, "k", "mark", mode="full")) == rows(new)
    empty = frame(spark, [], schema)
    assert M.incremental(empty, new, "k", "mark").count() == 0
    with pytest.raises(ValueError, match="schema changed"):
        M.incremental(target, new.withColumn("extra", F.lit(1)), "k", "mark")


def test_run_log(spark):
    log = frame(spark, [], RUN_LOG)
    at, day = datetime(2026, 5, 20, 6), date(2026, 5, 20)
    log = R.started(log, R.change(spark, execution_date=day, started_at=at))
    log = R.record(log, R.change(spark, execution_date=day, adzuna_count=3, jooble_count=0, remoteok_count=1,
                                 gupy_count=0, raw_inserted=4), R.EXTRACT)
    log = R.record(log, R.change(spark, execution_date=day, dedup_new=3, dedup_duplicates=1), R.DEDUP)
    log = R.record(log, R.change(spark, execution_date=day, ended_at=datetime(2026, 5, 20, 6, 1, 30),
                                 status="SUCCESS", classified_count=3, error_message=None), R.END)
    [row] = R.history(log).collect()
    assert (row["seconds"], row["status"], row["raw_inserted"], row["dedup_new"]) == (90, "SUCCESS", 4, 3)
    again = R.started(log, R.change(spark, execution_date=day, started_at=at)).collect()[0]
    assert (again["status"], again["ended_at"], again["raw_inserted"]) == ("RUNNING", None, 4)


def test_get_or_create(spark):
    known = frame(spark, [("c0", "Nubank")], "id string, name string")
    batch = frame(spark, [(" nubank", 1), ("iFood ", 2), ("ifood", 1), (None, 1)], "name string, n int")
    made = L.get_or_create(known, batch, "name", [F.col("n")], "company")
    assert sorted(r["name"] for r in made.collect()) == ["Nubank", "ifood"]
    assert rows(L.get_or_create(made, batch, "name", [F.col("n")], "company")) == rows(made)


def test_unprocessed_ignores_the_source_and_keeps_rows_without_id(spark):
    at = datetime(2026, 1, 1)
    raw = frame(spark, [("r1", "a", "1", at), ("r2", "b", "1", at), ("r3", "a", None, at), ("r4", "a", "2", None)],
                "id string, source string, source_id string, ingested_at timestamp")
    jobs = frame(spark, [("j", ["1", "9"])], "job_id string, source_ids array<string>")
    assert [r[0] for r in rows(L.unprocessed(raw, jobs))] == ["r3", "r4"]
    assert [r["id"] for r in L.unprocessed(raw, jobs, limit=1).collect()] == ["r4"]


def test_with_description_takes_the_earliest(spark):
    raw = frame(spark, [("r2", "1", "late", datetime(2026, 1, 2)), ("r1", "1", "early", datetime(2026, 1, 1))],
                "id string, source_id string, description string, ingested_at timestamp")
    jobs = frame(spark, [("j1", ["1", "2"]), ("j2", []), ("j3", None)], "job_id string, source_ids array<string>")
    found = {r["job_id"]: r["description"] for r in L.with_description(jobs, raw).collect()}
    assert found == {"j1": "early", "j2": None, "j3": None}


def test_insert_if_absent_with_thin_rank(spark):
    target = frame(spark, [("a", "s", "1", 0)], RAW)
    batch = frame(spark, [("b", "s", "1", 1), ("c", "s", "2", 2), ("d", "s", "2", 3), ("e", "t", "1", 4),
                          ("f", "s", None, 5), ("g", "s", None, 6)], RAW)
    args = (["source", "source_id"], [F.col("n"), F.col("id")], "source_id")
    assert rows(M.insert_if_absent(target, batch, *args, row_id="id")) == rows(M.insert_if_absent(target, batch, *args))
    plan = M.new_rows(target, batch.withColumn("text", F.repeat("id", 9)), *args, row_id="id")._jdf.queryExecution().optimizedPlan()
    windows = [line for line in plan.toString().splitlines() if "Window [" in line]
    assert windows and all("text" not in line for line in windows)


def test_bucketed_targets_have_no_exchange(spark, tmp_path):
    from garimpo.sources.tables import read_bucketed, write_bucketed

    jobs = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("v"), F.array(F.lit("x")).alias("ids"))
    stored = write_bucketed(jobs, str(tmp_path), "jobs", "k", 8)
    changes = jobs.filter("k like '1%'").select("k", F.lit("b").alias("v"))
    items = changes.select("k", F.lit("y").alias("item"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merges = {
            "update": (M.update_by_key(stored, changes, "k", ["v"]), M.update_by_key(jobs, changes, "k", ["v"])),
            "set": (M.set_by_ids(stored, changes, "k", {"v": F.lit("c")}), M.set_by_ids(jobs, changes, "k", {"v": F.lit("c")})),
            "append": (M.append_to_array(stored, items, "k", "ids", "item"), M.append_to_array(jobs, items, "k", "ids", "item")),
            "insert": (M.insert_if_absent(stored, changes, ["k"], [F.col("v")]), M.insert_if_absent(jobs, changes, ["k"], [F.col("v")])),
        }
        for name, (bucketed, plain) in merges.items():
            plan = bucketed._jdf.queryExecution().executedPlan().toString()
            held = plan.splitlines()
            scans = [i for i, line in enumerate(held) if "Bucketed: true" in line]
            assert scans, name
            for i in scans:  # up from the scan to the join: no exchange on the way
                depth = len(held[i]) - len(held[i].lstrip(" :+-*()0123456789"))
                for line in reversed(held[:i]):
                    up = len(line) - len(line.lstrip(" :+-*()0123456789"))
                    if up < depth:
                        depth = up
                        assert "Exchange" not in line, (name, plan)
                        if "Join" in line:
                            break
            assert rows(bucketed) == rows(plain), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    location = next((tmp_path / "jobs").iterdir())
    again = read_bucketed(spark, str(location), "k STRING, v STRING, ids ARRAY<STRING>", "jobs", "k", 8)
    assert rows(again) == rows(jobs)
