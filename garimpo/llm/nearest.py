"""Exact top-k search by integer inner product: tiles of queries and shards.

Candidates are dealt into shards and queries into blocks of bounded size.  Every
(block, shard) tile is one matrix product; a tile keeps its k best per query, and
the lists of the tiles are merged in two levels.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import matrix, usable

LEAST = np.iinfo(np.int64).min


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows; sums beyond 2**53 are added as Python integers."""
    width = max(left.shape[1], right.shape[1])
    left, right = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (left, right))
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(width, 1)
    if bound < 2**53:
        return (left @ right.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in right]
    out = [[sum(int(x) * y for x, y in zip(row, other)) for other in whole] for row in left]
    top = np.iinfo(np.int64).max
    return np.array([[min(max(x, LEAST + 1), top) for x in row] for row in out], dtype=np.int64)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, shard_rows: int = 8192,
    block_rows: int = 1024,
) -> DataFrame:
    """The k candidates of highest score for every query: query_id, rank, vec_id, score.

    Both inputs have vec_id and embedding; further columns are ignored.  A
    component x counts as floor(scale * x).  A query is never its own candidate (rows
    with its vec_id are left out).  Ties go to the smaller vec_id; repeated
    rows are candidates each.  Vectors that are null, or hold null or non-finite
    components, and rows without vec_id take no part; shorter vectors count as padded by
    zeros; scores beyond a long are cut to its range.  Fewer candidates than k:
    all of them.  Without queries or candidates the result is empty.
    """
    keep = f"vec_id is not null and {usable('embedding')}"
    left = queries.where(keep).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    right = vectors.where(keep).select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("held"))
    shards = max(1, ceil(right.count() / shard_rows))
    blocks = max(1, ceil(left.count() / block_rows))
    mark = F.monotonically_increasing_id()
    right = right.withColumn("shard", F.pmod(F.xxhash64("id", mark), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    left = left.withColumn("block", F.pmod(F.xxhash64("vec_id", mark), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )

    def tile(asked: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(asked) and len(held):
            held = held.sort_by("id")
            own, ids = asked["vec_id"].to_numpy(), held["id"].to_numpy()
            scores = _products(np.floor(matrix(asked["embedding"]) * scale), np.floor(matrix(held["held"]) * scale))
            low, high = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
            for i in np.flatnonzero(high > low):
                scores[i, low[i] : high[i]] = LEAST
            rows = np.arange(len(own))
            for _ in range(min(k, len(ids))):
                best = scores.argmax(axis=1)
                value = scores[rows, best]
                real = value > LEAST
                found.append((own[real], ids[best[real]], value[real]))
                scores[rows, best] = LEAST
        q, v, s = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    lists = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(tile, "query_id long, vec_id long, score long")
    )
    order = [F.col("score").desc(), F.col("vec_id")]
    branch = Window.partitionBy("query_id", "branch").orderBy(*order)
    merged = (
        lists.withColumn("branch", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, ceil(shards**0.5)))))
        .withColumn("rank", F.row_number().over(branch))
        .where(F.col("rank") <= k)
    )
    whole = Window.partitionBy("query_id").orderBy(*order)
    return (
        merged.withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
