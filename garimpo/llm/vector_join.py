"""Near copies of vectors: an exact metric range join.

Unit vectors of equal labels are split by their nearest pivot.  Two vectors within
distance e have pivots whose distances differ by at most 2 e, so a vector is
replicated to exactly the cells for which that holds; every cell then finds the
partners of its own vectors alone.  Equal vectors are one class with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, matrix, united, usable, written


def _units(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True, initial=1e-300)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _spread(sample: np.ndarray, n: int) -> np.ndarray:
    """At most n rows of the sample, each the farthest from those before it."""
    if not len(sample):
        return sample
    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    return sample[chosen]


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, cell_rows: int = 4096, tile_rows: int = 4096,
    max_pivots: int = 256, pivot_sample: int = 1024,
) -> DataFrame:
    """Links of cosine >= threshold between vectors of one label, and their components.

    One row per input row: vec_id, label, n_links, component_id, kept.  Vectors
    that are null, zero, or hold null or non-finite components, and rows with null label or
    null vec_id, link with nothing and are their own component.  Vectors of
    different lengths never link.  Repeated rows are linked with each other and
    counted each.  An empty table gives no rows; other columns are ignored.

    Pivots are chosen from ``pivot_sample`` classes; how many of them divide a label
    follows its number of classes.  A cell of more than ``tile_rows`` rows is
    compared in tiles of two blocks, so that no task holds a whole hot cell.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    good = (
        f"vec_id is not null and label is not null and {usable('embedding')} and exists(embedding, x -> x <> 0)"
    )
    valid, other = rows.where(good), rows.where(f"not coalesce({good}, false)")
    classes = valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    classes = classes.withColumn("dims", F.size("embedding"))

    sizes = classes.groupBy("label", "dims").agg(F.count("*").alias("n"))
    parts = sizes.select("label", "dims", F.least(F.lit(max_pivots), F.ceil(F.col("n") / cell_rows)).alias("parts"))
    sample = classes.orderBy(F.xxhash64("embedding"), "class").limit(pivot_sample).select("embedding").toArrow()
    pivots = _spread(_units(matrix(sample["embedding"])), max_pivots) if len(sample) else np.zeros((0, 0))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9

    def deal(batches):
        for batch in batches:
            units = _units(matrix(batch.column("embedding"))) if len(batch) else np.zeros((0, 0))
            width = max(units.shape[1], pivots.shape[1])
            u, p = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (units, pivots))
            dot = u @ p.T
            used = np.arange(len(p))[None, :] < batch.column("parts").to_numpy()[:, None]
            far = np.where(used, np.sqrt(np.maximum(0, 2 - 2 * dot)), np.inf)
            home = far.argmin(axis=1)
            least = far[np.arange(len(far)), home] if len(far) else np.empty(0)
            gap = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))
            plane = dot[np.arange(len(far)), home][:, None] - dot <= reach * gap[home] + 1e-9
            row, cell = np.nonzero(used & plane & (far - least[:, None] <= 2 * reach))
            out = batch.drop_columns(["parts"]).take(pa.array(row))
            out = out.append_column("cell", pa.array(cell.astype(np.int32)))
            yield out.append_column("home", pa.array(cell == home[row]))

    fields = "label {}, dims int, class long, copies long, embedding {}".format(
        *(classes.schema[c].dataType.simpleString() for c in ("label", "embedding"))
    )
    dealt = classes.join(parts, ["label", "dims"]).select("label", "dims", "class", "copies", "embedding", "parts")
    cells = written(dealt.mapInArrow(deal, fields + ", cell int, home boolean"), "cells")
    key = ["label", "dims", "cell"]
    blocks = cells.groupBy(*key).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("blocks"))
    tiled = (
        cells.join(blocks, key)
        .withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
        .withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("i", F.least("block", "with"))
        .withColumn("j", F.greatest("block", "with"))
    )

    def compare(group: pa.Table) -> pa.Table:
        block = group["block"].to_numpy()
        one, same = block == group["i"][0].as_py(), group["i"][0].as_py() == group["j"][0].as_py()
        units, copies = _units(matrix(group["embedding"])), group["copies"].to_numpy()
        left = np.flatnonzero(one)
        right = left if same else np.flatnonzero(~one)
        links, label = np.zeros(len(block), dtype=np.int64), np.arange(len(block))
        for at in range(0, len(left), 512):
            rows_ = left[at : at + 512]
            a, b = np.nonzero(units[rows_] @ units[right].T >= threshold)
            a, b = rows_[a], right[b]
            a, b = a[a != b], b[a != b]
            np.add.at(links, a, copies[b])
            if not same:
                np.add.at(links, b, copies[a])
            label = united(len(block), a, b, label)
        ids = group["class"].to_numpy()
        links[~group["home"].to_numpy(zero_copy_only=False)] = 0
        kept = (links > 0) | (label != np.arange(len(block)))
        return pa.table({"a": ids[kept], "b": ids[label[kept]], "links": links[kept]})

    found = tiled.groupBy(*key, "i", "j").applyInArrow(compare, "a long, b long, links long")
    found = written(found, "pairs")
    parted = components(found.select("a", "b"))
    counted = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "class")
    named = classes.select("class", "label", "embedding", "least", "copies").join(
        parted.withColumnRenamed("node", "class"), "class", "left"
    )
    named = named.withColumn("component", F.coalesce("component", "class"))
    heads = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = (
        named.join(heads, "component")
        .join(counted, "class", "left")
        .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    linked = valid.join(result, ["label", "embedding"]).select("vec_id", "label", "n_links", "component_id")
    alone = other.select("vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(False)))


