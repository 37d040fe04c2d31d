"""Hard negatives of anchors: rows of other labels that score high, but not too high.

Search by coordinate pruning.  Candidates are dealt into shards; a shard is cut into buckets by
length, each with its rows sorted by every coordinate of their directions.  A lower bound of
the scores still wanted bounds the angle between an anchor and a row of a bucket, hence
the row's value at the anchor's largest (focus) coordinates: those ranges of the sorted lists are
intersected, and what is in all of them is scored exactly.  A bucket whose longest row cannot
reach the bound is passed over.  Bounds rise as a shard's buckets, longest first, are done.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import matrix, usable, written

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
ROUNDING = 1e-9


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, cut to the range of a long."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(left.shape[1], 1)
    if bound < 2**53:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (left, right)]
    return np.clip(whole[0] @ whole[1].T, LEAST + 1, MOST).astype(np.int64)


class Bucket:
    """Rows of similar length with a sorted list per coordinate of their directions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, lengths: np.ndarray):
        order = np.argsort(ids, kind="stable")  # so that the first of equal scores is the smallest id
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        self.longest = float(lengths.max())
        directions = self.rows / np.maximum(lengths[order], 1e-300)[:, None]
        self.order = np.argsort(directions, axis=0, kind="stable")
        self.sorted = np.take_along_axis(directions, self.order, axis=0)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(len(ids))[:, None], axis=0)

    def possible(self, units: np.ndarray, focus: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Which rows (second axis) may have at least that cosine with which anchors (first axis)."""
        n, m = len(units), len(self.ids)
        alive = np.zeros((n, m), dtype=bool)
        if not n:
            return alive
        value = np.take_along_axis(units, focus, axis=1)
        angle, spread = np.arccos(np.clip(value, -1, 1)), np.arccos(np.clip(cosine, -1, 1))[:, None]
        low = np.cos(np.minimum(np.pi, angle + spread)) - ROUNDING
        high = np.cos(np.maximum(0, angle - spread)) + ROUNDING
        begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            begin[at] = np.searchsorted(self.sorted[:, f], low[at], side="left")
            end[at] = np.searchsorted(self.sorted[:, f], high[at], side="right")
        best = (end - begin).argmin(axis=1)  # the shortest range is listed, the others are tested
        each = np.arange(n)
        first, count = begin[each, best], np.maximum(0, (end - begin)[each, best])
        anchor = np.repeat(each, count)
        place = np.arange(len(anchor)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        row = self.order[place, focus[anchor, best[anchor]]]
        for k in range(focus.shape[1]):
            rank = self.rank[row, focus[anchor, k]]
            inside = (rank >= begin[anchor, k]) & (rank < end[anchor, k])
            anchor, row = anchor[inside], row[inside]
        alive[anchor, row] = True
        return alive


def _best(
    asked: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, held: dict[str, np.ndarray], k: int, same: bool,
    bucket_rows: int, focus_count: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(wish, id, score): for each anchor and range of scores the k best rows, smaller ids first among equals.

    ``low`` and ``high`` hold the ranges, one anchor a row; a range with low > high is void.
    Wishes number the ranges of the first anchor, then those of the next.
    """
    vectors, rows = asked["vector"], held["vector"]
    width = max(vectors.shape[1], rows.shape[1])
    vectors, rows = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (vectors, rows))
    n, ranges = low.shape
    top = np.full((n, ranges, k), LEAST, dtype=np.int64)
    names = np.zeros((n, ranges, k), dtype=np.int64)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors / np.maximum(norm, 1e-300)[:, None]
    focus = np.argsort(-np.abs(units), axis=1, kind="stable")[:, : min(focus_count, width)]
    lengths = np.sqrt((rows * rows).sum(axis=1))
    by_length = np.argsort(-lengths, kind="stable")
    void = low > high
    for at in range(0, len(rows) if width else 0, bucket_rows):
        part = by_length[at : at + bucket_rows]
        bucket = Bucket(held["id"][part], held["label"][part], rows[part], lengths[part])
        bound = np.where(void, MOST, np.maximum(low, top[:, :, -1])).min(axis=1)  # a tie may still be a smaller id
        reach = norm * bucket.longest
        cosine = np.where(bound > 0, bound / np.maximum(reach, 1e-300), -1.0)
        live = np.flatnonzero(~void.all(axis=1) & (cosine <= 1 + ROUNDING))
        for some in np.array_split(live, max(1, ceil(len(live) * len(part) / 2**20))):
            alive = bucket.possible(units[some], focus[some], cosine[some] - ROUNDING)
            agrees = asked["label"][some][:, None] == bucket.labels[None, :]
            alive &= agrees if same else ~agrees
            alive &= asked["id"][some][:, None] != bucket.ids[None, :]
            near, far = alive.any(axis=1), np.flatnonzero(alive.any(axis=0))
            some, alive = some[near], alive[near][:, far]
            if not alive.size:
                continue
            scores = np.where(alive, _scores(vectors[some], bucket.rows[far]), LEAST)
            ids = bucket.ids[far]
            for r in range(ranges):
                least = np.maximum(low[some, r], top[some, r, -1])[:, None]
                fits = np.where((scores >= least) & (scores <= high[some, r][:, None]), scores, LEAST)
                which = np.flatnonzero((fits > LEAST).any(axis=1))
                fits = fits[which]
                found_ids, found = [names[some[which], r]], [top[some[which], r]]
                for _ in range(min(k, len(ids)) if len(which) else 0):
                    best = fits.argmax(axis=1)
                    found.append(fits[np.arange(len(which)), best][:, None])
                    found_ids.append(ids[best][:, None])
                    fits[np.arange(len(which)), best] = LEAST
                joined, joined_ids = np.concatenate(found, axis=1), np.concatenate(found_ids, axis=1)
                order = np.lexsort((joined_ids, ~joined), axis=1)[:, :k]
                top[some[which], r] = np.take_along_axis(joined, order, axis=1)
                names[some[which], r] = np.take_along_axis(joined_ids, order, axis=1)
    real = top > LEAST
    wish = np.repeat(np.arange(n * ranges), real.reshape(-1, k).sum(axis=1))
    return wish, names[real], top[real]


def _columns(table: pa.Table, vector: str, label: str, name: str, scale: float) -> dict[str, np.ndarray]:
    return {
        "vector": np.floor(matrix(table[vector]) * scale),
        "label": table[label].to_numpy(),
        "id": table[name].to_numpy(),
    }


def _merged(lists: DataFrame, key: list[str], k: int, branches: int) -> DataFrame:
    """The k best of the lists of all tiles with their rank, merged in two levels."""
    order = [F.col("score").desc(), F.col("id")]
    for parts in ([*key, "branch"], key):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
        lists = lists.withColumn("branch", F.pmod(F.xxhash64("id"), F.lit(branches)))
        lists = lists.withColumn("rank", rank).where(F.col("rank") <= k)
    return lists.drop("branch")


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: float = 256.0, tile_bytes: int = 2**25, least_rows: int = 2048, bucket_rows: int = 1024, focus: int = 3,
) -> DataFrame:
    """Hard negatives of each (anchor, positive): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; rows for which ``anchors`` holds are anchors.
    A component x counts as floor(scale * x).  An anchor's positives are its ``positives`` best
    rows of its label by inner product; the negatives of one are the ``negatives`` best rows of other
    labels whose score is from ``low`` to ``high`` per cent of the positive's, ends included.
    Equal scores go by smaller vec_id.  A row of the anchor's vec_id is neither.  Rows without
    vec_id, label or vector and those with null or non-finite components take no part; of
    anchors that repeat a vec_id one counts, other repeated rows count each; shorter vectors are padded
    by zeros; scores beyond a long are cut to its range.  Fewer rows than asked: all of them.  A
    positive without negatives has no row.

    A shard and a block of anchors hold about ``tile_bytes`` of doubles each (a shard is smaller, of
    ``least_rows`` at least, where there are too few for all cores), so candidates are copied once per
    block, anchors once per shard.
    """
    whole = vectors.schema["label"].dataType.typeName() in ("byte", "short", "integer", "long")
    mark = F.col("label").cast("long") if whole else F.xxhash64("label")
    rows = vectors.where(f"vec_id is not null and label is not null and {usable('embedding')}").select(
        F.col("vec_id").cast("long").alias("id"), mark.alias("label"), "embedding", F.coalesce(anchors, F.lit(False)).alias("anchor")
    )
    rows = written(rows.withColumn("mark", F.xxhash64("id", F.monotonically_increasing_id())), "vectors")
    # Of the rows of an anchor's id the one of least label and vector counts.
    chosen = rows.where("anchor").groupBy("id").agg(F.min(F.struct("label", "embedding")).alias("x"))
    chosen = written(chosen.select("id", "x.label", "x.embedding"), "anchors")
    size, widest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    tile_rows = max(1, tile_bytes // (8 * max(1, widest)))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shard_rows = min(tile_rows, max(least_rows, ceil(size / cores)))

    candidates = rows.select("mark", "id", "label", "embedding")
    asking = chosen.select(F.col("id").alias("anchor_id"), F.col("label").alias("own"), F.col("embedding").alias("asked"))

    per_label = rows.groupBy("label").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    per_anchor = chosen.groupBy("label").agg(F.ceil(F.count("*") / tile_rows).alias("blocks"))
    labels = per_label.join(per_anchor, "label")
    left = asking.join(labels, asking["own"] == labels["label"]).select(
        "anchor_id", "own", "asked", F.col("own").alias("at"), F.pmod(F.xxhash64("anchor_id"), "blocks").alias("block"),
        F.explode(F.expr("sequence(0L, shards - 1)")).alias("shard"),
    )
    right = candidates.join(labels, "label").select(
        "id", "label", "embedding", F.col("label").alias("at"), F.pmod("mark", "shards").alias("shard"),
        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
    )

    def nearest(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return pa.table({c: np.empty(0, np.int64) for c in ("anchor_id", "id", "score")})
        a, h = _columns(asked, "asked", "own", "anchor_id", scale), _columns(held, "embedding", "label", "id", scale)
        every = np.full((len(asked), 1), LEAST + 1), np.full((len(asked), 1), MOST)
        wish, ids, scores = _best(a, *every, h, positives, True, bucket_rows, focus)
        return pa.table({"anchor_id": a["id"][wish], "id": ids, "score": scores})

    key = ["at", "shard", "block"]
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(nearest, "anchor_id long, id long, score long")
    branches = max(1, ceil((size / shard_rows) ** 0.5))
    best = _merged(near, ["anchor_id"], positives, branches)
    lists = best.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), "score"))).alias("positives")
    )
    wishes = written(asking.join(lists, "anchor_id"), "wishes")

    shards, blocks = max(1, ceil(size / shard_rows)), max(1, ceil(wishes.count() / tile_rows))
    left = wishes.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    right = candidates.withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int")).drop("mark").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    names = ["anchor_id", "slot", "positive_id", "positive_score", "id", "score"]

    def mined(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return pa.table({c: np.empty(0, np.int64) for c in names})
        a, h = _columns(asked, "asked", "own", "anchor_id", scale), _columns(held, "embedding", "label", "id", scale)
        wanted = asked["positives"].to_pylist()
        shape = len(wanted), max(map(len, wanted))
        least, most = np.full(shape, MOST), np.full(shape, LEAST)
        slots, scores = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for i, found in enumerate(wanted):
            for j, p in enumerate(found):
                slots[i, j], scores[i, j] = p["positive_id"], p["score"]
                least[i, j] = max(LEAST + 1, -(-low * p["score"] // 100))
                most[i, j] = min(MOST, high * p["score"] // 100)
        wish, ids, found = _best(a, least, most, h, negatives, False, bucket_rows, focus)
        anchor, slot = np.divmod(wish, shape[1])
        return pa.table(dict(zip(names, (a["id"][anchor], slot, slots[anchor, slot], scores[anchor, slot], ids, found))))

    tiles = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        mined, ", ".join(f"{c} long" for c in names)
    )
    merged = _merged(tiles, ["anchor_id", "slot"], negatives, branches)
    return merged.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
