"""Landing envelopes: one per source and day.

Two layouts are understood.  The native one keeps a posting per row under
``source=…/ds=…`` and splits freely.  The exchange one is a single JSON
document per source and day (``{source}/{ds}/raw_jobs.json``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


ROW_SCHEMA = "source STRING, ds DATE, extracted_at TIMESTAMP, payload STRING"
EXCHANGE_FILE = "raw_jobs.json"


# --- reading ------------------------------------------------------------------
def _path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system; other failures are raised."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_landing(
    spark: SparkSession, root: str, source: str | None = None, ds: str | None = None, with_place: bool = False
) -> DataFrame:
    """Rows of the native layout; empty with the same schema when nothing landed.

    With ``with_place`` also ``place``: the name of a row's file and its index in it, the same in
    every run and for any split of the scan.
    """
    places = ["place"] if with_place else []
    if not _path_exists(spark, root):
        return spark.createDataFrame([], ROW_SCHEMA + ", place STRING" * with_place)
    rows = spark.read.schema(ROW_SCHEMA).parquet(root)
    if with_place:
        rows = rows.withColumn("place", F.concat_ws("#", "_metadata.file_name", "_metadata.row_index"))
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    if ds is not None:
        rows = rows.filter(F.col("ds") == F.lit(ds).cast("date"))
    return rows.select("source", "ds", "extracted_at", "payload", *places)


def read_exchange(spark: SparkSession, root: str, source: str, ds: str) -> DataFrame:
    """Postings of one exchange document as JSON text; empty when the file is missing.

    A document of this layout is one JSON value, so it is read whole by one
    task: use it for exchange only.
    """
    path = f"{root}/{source}/{ds}/{EXCHANGE_FILE}"
    if not _path_exists(spark, path):
        return spark.createDataFrame([], "source STRING, ds DATE, payload STRING")
    envelope = spark.read.option("multiLine", True).option("singleVariantColumn", "doc").json(path)
    return envelope.select(
        F.lit(source).alias("source"),
        F.lit(ds).cast("date").alias("ds"),
        F.explode(F.try_variant_get("doc", "$.results", "array<variant>")).alias("item"),
    ).select("source", "ds", F.to_json("item").alias("payload"))


# --- writing ------------------------------------------------------------------
def write_landing(rows: DataFrame, root: str) -> None:
    """Write rows of the native layout; a second run of a day replaces that day.

    The rebalancing exchange splits a large day and joins small ones by their measured
    size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so one dominant
    source is not written by one task.
    """
    (
        rows.hint("rebalance", "source", "ds")
        .write.partitionBy("source", "ds")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def manifest(rows: DataFrame) -> DataFrame:
    """Envelope metadata per source and day: when it was taken, how many results."""
    return rows.groupBy("source", "ds").agg(
        F.max("extracted_at").alias("extracted_at"), F.count(F.lit(1)).alias("total_results")
    )


# --- shaping ------------------------------------------------------------------
def split_feed(feeds: DataFrame, items: str = "items") -> tuple[DataFrame, DataFrame]:
    """A feed whose first element is metadata: (metadata rows, posting rows)."""
    others = [c for c in feeds.columns if c != items]
    exploded = feeds.select(*others, F.posexplode(items).alias("pos", "item"))
    return exploded.filter("pos = 0").drop("pos"), exploded.filter("pos > 0")


def tagged_union(pages: Mapping[str, DataFrame], column: str = "search_term") -> DataFrame:
    """Result pages of several search terms under one another, repeats kept."""
    parts = [page.withColumn(column, F.lit(term)) for term, page in pages.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cap_per_term(
    rows: DataFrame, term: str, order: Iterable[Column], cap: int
) -> DataFrame:
    """The first ``cap`` rows of every term.  Spark trims each task to the cap
    before the shuffle, so a dominant term moves only ``cap`` rows per task."""
    place = F.row_number().over(Window.partitionBy(term).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= cap).drop("_place")
