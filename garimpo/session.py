"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("garimpo")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="garimpo-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, for tables that are written and read back."""
    return f"{_checkpoint_root(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared folder.

    For rows with long texts: later steps read the columns they need.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, counters: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``stored`` rows and one row of counters, observed in the pass that writes them.

    Counters are aggregates over the rows; nothing is scanned again for them.
    """
    seen = Observation()
    held = stored(df.observe(seen, *[c.alias(n) for n, c in counters.items()]), name)
    values = seen.get
    row = df.sparkSession.range(1).select(*[F.lit(values[n] or 0).cast("long").alias(n) for n in counters])
    return held, row


def spread(scan: DataFrame) -> DataFrame:
    """Give every core work when a scan has fewer splits than the cluster has cores.

    For small or badly split inputs before CPU-heavy expressions; a large input
    has splits enough and stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
