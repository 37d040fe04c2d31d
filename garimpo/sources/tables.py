"""Tables: views for staging, written tables for everything that is read twice."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """A declared source table; the schema is given, never inferred."""
    return spark.read.schema(schema).format(form).load(path)


def write_table(
    df: DataFrame, root: str, name: str, partition_by: Iterable[str] = (), form: str = "parquet"
) -> str:
    """Write to a folder no reader uses yet and return its path.

    A table is never overwritten while it may be read: the caller switches to
    the returned path (or the view made by ``publish``).
    """
    path = f"{root}/{name}/v={uuid4().hex}"
    df.write.mode("errorifexists").format(form).partitionBy(*partition_by).save(path)
    return path


def write_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write a keyed table in buckets of its key and return it.

    Merges on the key read it without an exchange: the other side alone is shuffled, to the same
    number of buckets.  Choose ``buckets`` by the table's size, some 200 MB each, and keep it from run to
    run.  The table is external; its name is known to this session, ``read_bucketed`` names it again
    in another one.
    """
    path = f"{root}/{name}/v={uuid4().hex}"
    table = f"{name}_{uuid4().hex}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def read_bucketed(spark: SparkSession, path: str, schema: str, name: str, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` wrote in an earlier session."""
    table = f"{name}_{uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(table)


def append_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("append").format(form).save(path)


def publish(views: Mapping[str, DataFrame]) -> None:
    """Name DataFrames for SQL readers."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def materialise(
    build: Mapping[str, DataFrame] | Callable[[Callable[[DataFrame, str], DataFrame]], Mapping[str, DataFrame]],
    root: str,
    views: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Staging models stay views; each other one is written, read back and named.

    ``build`` gets what keeps a model (see ``stored_in``) and returns the models, so each is built from
    the written ones before it: what they share is computed, and broadcast, once.  Models that are
    planned already may be given as they are.
    """
    keep = stored_in(root, views)
    stored = {name: keep(df, name) for name, df in build.items()} if isinstance(build, Mapping) else dict(build(keep))
    publish(stored)
    return stored


def stored_in(root: str, views: Iterable[str] = ()) -> Callable[[DataFrame, str], DataFrame]:
    """How models are kept: written under ``root`` and read back, those named in ``views`` as they are."""
    stay = set(views)

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name in stay:
            return df
        return df.sparkSession.read.schema(df.schema).parquet(write_table(df, root, name))

    return keep
