"""A fact stored by load day: an increment reads and writes the days it touches.

The table is a Parquet folder with one partition per day of the mark (when a row was
ingested), or per month or year where days hold little.  A load reads the mark from the newest day alone, the key column to learn which days
hold keys that arrive again, and whole rows of those days only; it overwrites these partitions and
adds new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.merge import require_same_schema
from ..session import stored

DAY, NO_DAY = "load_day", "__HIVE_DEFAULT_PARTITION__"


def _by_day(rows: DataFrame, mark: str, unit: str) -> DataFrame:
    return rows.withColumn(DAY, F.to_date(F.date_trunc(unit, mark)))


def write_days(rows: DataFrame, path: str, mark: str, unit: str = "day") -> None:
    """First load or full rebuild: every day anew.  ``path`` must not be what ``rows`` are read from."""
    dealt = _by_day(rows, mark, unit).repartition(F.col(DAY))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path)


def _stored_days(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The partitioned table; what its files hold is compared with the rows that arrive."""
    found = spark.read.option("mergeSchema", "false").parquet(path)
    require_same_schema(found.drop(DAY), like)
    return spark.read.schema(found.schema).parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The fact without the partition column."""
    return spark.read.parquet(path).drop(DAY)


def in_days(days: list) -> Column:
    """Rows of these partitions, None for rows without a mark."""
    named = [F.lit(d) for d in days if d is not None]
    condition = F.col(DAY).isin(*named) if named else F.lit(False)
    return condition | F.col(DAY).isNull() if None in days else condition


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def newest_day(spark: SparkSession, path: str) -> str | None:
    """The last partition by name, from the listing of the table's folder."""
    folder, files = _folder(spark, path)
    names = [s.getPath().getName().partition("=")[2] for s in files.listStatus(folder) if s.isDirectory()]
    return max((n for n in names if n and n != NO_DAY), default=None)


def above_stored_mark(fact: DataFrame, rows: DataFrame, mark: str, newest: str | None) -> DataFrame:
    """Rows above the highest mark, which is read from the newest day's partition."""
    top = fact.filter(F.col(DAY) == F.lit(newest).cast("date")).agg(F.max(mark)).first()[0]
    return rows.filter(F.col(mark) > F.lit(top))


def load_days(rows: DataFrame, path: str, key: str, mark: str, unit: str = "day") -> list:
    """Replace-by-key load of the rows above the mark; returns the days it wrote or emptied.

    Rows at or below the mark are never revisited; an empty table takes nothing, as its mark is
    NULL.  Columns or types that differ from the table's raise ValueError before anything is
    written.  Running the load again changes nothing.
    """
    spark = rows.sparkSession
    fact = _stored_days(spark, path, rows)
    fresh = stored(_by_day(above_stored_mark(fact, rows, mark, newest_day(spark, path)), mark, unit), "fresh")
    again = fact.select(key, DAY).join(fresh.select(key), key, "left_semi").select(DAY)
    # Days, not rows: at most one a day since the first load.
    days = [r[0] for r in again.unionByName(fresh.select(DAY)).distinct().collect()]
    if not days:
        return []
    stay = fact.filter(in_days(days)).join(fresh.select(key), key, "left_anti").select(*fact.columns)
    # Written aside first: the partitions are overwritten while their old rows are read otherwise.
    whole = stored(stay.unionByName(fresh.select(*fact.columns)), "touched")
    held = {r[0] for r in whole.select(DAY).distinct().collect()}
    whole.repartition(F.col(DAY), F.pmod(F.xxhash64(key), F.lit(8))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(DAY).parquet(path)
    _drop_days(spark, path, [d for d in days if d not in held])
    return sorted(days, key=str)


def _drop_days(spark: SparkSession, path: str, days: list) -> None:
    """Partitions that lost all their rows; an overwrite leaves them as they are."""
    for day in days:
        folder, files = _folder(spark, f"{path}/{DAY}={NO_DAY if day is None else day.isoformat()}")
        files.delete(folder, True)
