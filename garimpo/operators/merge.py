"""Keyed merges as pure functions: (target, changes) -> new target.

The caller writes the result to a new place; nothing here overwrites a table
that is being read.  Keys of both sides are joined as they are, so AQE chooses
a broadcast for a small batch and splits a skewed key for a big one, and a target
in buckets of its key (``sources.tables.write_bucketed``) is read without an exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given total order.

    The rank filter is applied before the shuffle as well, so a key that holds
    a large share of the rows sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    nullable_key: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Rows of the batch whose key the target does not have; first of a key wins.

    Rows without ``nullable_key`` are always new.  They skip the shuffle: all of
    them would meet in one partition.  With ``row_id``, a column that no two rows of the
    batch share, only keys, order and ids are ranked; long texts are fetched by id at the end.
    """
    keyed = batch if nullable_key is None else batch.filter(F.col(nullable_key).isNotNull())
    thin = keyed
    if row_id is not None:
        places = [c.alias(f"_order{i}") for i, c in enumerate(order)]
        thin, order = keyed.select(*dict.fromkeys([*keys, row_id]), *places), [F.col(f"_order{i}") for i in range(len(places))]
    fresh = first_per_key(thin, keys, order).join(target.select(*keys), list(keys), "left_anti")
    fresh = fresh.select(*batch.columns) if row_id is None else keyed.join(fresh.select(row_id), row_id, "left_semi")
    if nullable_key is None:
        return fresh
    return fresh.unionByName(batch.filter(F.col(nullable_key).isNull()))


def insert_if_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    nullable_key: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """The target with the new rows of the batch."""
    fresh = new_rows(target, batch, keys, order, nullable_key, row_id).select(*batch.columns)
    return target.unionByName(fresh, allowMissingColumns=True)


def update_by_key(
    target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Set ``columns`` from ``changes`` where the key matches; a NULL is set as well.

    ``changes`` has one row per key.
    """
    flagged = changes.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = target.join(flagged, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def set_where(target: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows that fulfil a condition.  No join, no shuffle."""
    return target.select(
        *[
            F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def set_by_ids(target: DataFrame, ids: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows whose key is in ``ids``."""
    marked = target.join(
        ids.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left"
    ).select(*target.columns, F.coalesce("_hit", F.lit(False)).alias("_hit"))
    return set_where(marked, F.col("_hit"), values).drop("_hit")


def append_to_array(
    target: DataFrame,
    additions: DataFrame,
    key: str,
    array: str,
    item: str,
    order: str | None = None,
) -> DataFrame:
    """Append items to the array of the matching row, each at most once.

    New items follow the old ones in ascending ``order`` (of the item itself by
    default); a NULL array stays NULL.  Items are made distinct before they
    meet, so repeats never travel to the key's task.
    """
    extra = (
        additions.filter(F.col(item).isNotNull())
        .groupBy(key, F.col(item).alias("_item"))
        .agg(F.min(order or item).alias("_order"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("_order", "_item"))).alias("_extra"))
    )
    old, items = F.col(array), F.col("_extra._item")
    return target.join(extra, key, "left").select(
        *[
            F.when(F.col("_extra").isNull() | old.isNull(), old)
            .otherwise(F.concat(old, F.array_except(items, old)))
            .alias(c)
            if c == array
            else F.col(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame, changes: DataFrame, key: str, update: Sequence[str]
) -> DataFrame:
    """Insert new keys whole; on a known key set only the columns in ``update``.

    ``changes`` has one row per key; columns it lacks are NULL on insert.
    """
    given = set(changes.columns)
    right = changes.select(
        key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in changes.columns if c != key]
    )
    joined = target.withColumn("_old", F.lit(True)).join(right, key, "full_outer")

    def merged(c: str) -> Column:
        if c == key or c not in given:
            return F.col(c)
        source = F.col("_new") if c in update else F.col("_new") & F.col("_old").isNull()
        return F.when(source, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in target.columns])


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True)


def require_same_schema(target: DataFrame, rows: DataFrame) -> None:
    """Refuse a load whose columns or types differ from the target's."""
    want = [(f.name, f.dataType.simpleString()) for f in target.schema.fields]
    have = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    if want != have:
        raise ValueError(f"schema changed: target {want}, rows {have}")


def above_mark(rows: DataFrame, target: DataFrame, mark: str) -> DataFrame:
    """Rows above the target's highest mark; nothing when the target is empty.

    The mark is a scalar subquery, so the comparison is a filter on the rows' own scan.
    """
    return rows.filter(F.col(mark) > target.agg(F.max(mark)).scalar())


def replace_by_key(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Delete the keys that arrive, then insert them."""
    return target.join(rows.select(key), key, "left_anti").select(*target.columns).unionByName(rows)


def incremental(
    target: DataFrame, rows: DataFrame, key: str, mark: str, mode: str = "append_new"
) -> DataFrame:
    """Load a fact: ``append_new`` takes rows above the high-water mark, ``full`` rebuilds.

    Rows at or below the mark are never revisited by ``append_new``.
    """
    require_same_schema(target, rows)
    if mode == "full":
        return rows
    if mode != "append_new":
        raise ValueError(f"unknown mode {mode!r}")
    return replace_by_key(target, above_mark(rows, target, mark), key)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
