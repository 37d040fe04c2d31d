"""The load step as an incremental file stream.

The landing zone grows by files.  Each run takes the files that earlier runs
have not seen, maps them and inserts the postings that are not there yet.  It
gives the same rows as ``plans.silver.load`` over everything.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed_values as V
from ..operators.merge import new_rows
from ..schemas import RAW_JOBS
from ..session import stored
from ..sources.envelopes import ROW_SCHEMA
from ..sources.mapping import map_all, with_own_ids

BATCH = "load_batch"


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Raw postings written so far."""
    return spark.read.schema(f"{RAW_JOBS}, {BATCH} BIGINT").parquet(path)


def load_new_files(
    spark: SparkSession,
    landing: str,
    raw: str,
    state: str,
    field_maps: Mapping[str, Mapping] = V.FIELD_MAPS,
) -> None:
    """Load the files not seen yet into ``raw``; ``state`` remembers what was seen.

    A batch owns one partition of ``raw`` and compares itself with earlier
    batches only, so a batch that is repeated after a failure writes the same
    rows to the same place.
    """
    columns = [f.split()[0] for f in RAW_JOBS.replace("\n", " ").split(",")]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("ingested_at", F.col("extracted_at"))
        mapped = with_own_ids(stored(map_all(rows, field_maps), "mapped"), batch_id)
        known = raw_table(spark, raw).filter(F.col(BATCH) < batch_id)
        fresh = new_rows(
            known, mapped, ["source", "source_id"],
            [F.col("ingested_at"), F.col("id"), F.col("payload")], nullable_key="source_id",
        )
        fresh.select(*columns).write.mode("overwrite").parquet(f"{raw}/{BATCH}={batch_id}")

    # The table exists before the first batch reads it.
    spark.createDataFrame([], RAW_JOBS).write.mode("overwrite").parquet(f"{raw}/{BATCH}=-1")
    stream = spark.readStream.schema(ROW_SCHEMA).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
