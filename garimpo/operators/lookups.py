"""Lookups between raw postings, jobs and their small dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.keys import lookup_key, natural_id
from .merge import first_per_key


def jobs_with_names(jobs: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """Jobs with the names of their company and location; unknown ids keep NULL."""
    company = companies.select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    location = locations.select(F.col("id").alias("location_id"), F.col("raw").alias("location_raw"))
    return jobs.join(company, "company_id", "left").join(location, "location_id", "left")


def name_map(dimension: DataFrame, name: str, id_column: str = "id") -> DataFrame:
    """Lookup table key -> id; one id per key."""
    keyed = dimension.select(lookup_key(F.col(name)).alias("key"), F.col(id_column).alias("id"))
    return keyed.groupBy("key").agg(F.min("id").alias("id"))


def get_or_create(
    dimension: DataFrame,
    rows: DataFrame,
    name: str,
    order: Sequence[Column],
    kind: str,
    source_name: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The dimension with a row for every name that occurs in ``rows``.

    Names that differ only in case or framing spaces are one entry; the first
    spelling (and the carried columns of that row) is kept.  Known entries are
    never changed.
    """
    source_name = source_name or name
    keyed = rows.filter(F.col(source_name).isNotNull()).withColumn(
        "_key", lookup_key(F.col(source_name))
    )
    # Known names leave first: in a daily run almost everything is known.
    known = dimension.select(lookup_key(F.col(name)).alias("_key"))
    fresh = first_per_key(keyed.join(known, "_key", "left_anti"), ["_key"], order)
    created = fresh.select(
        natural_id(kind, F.col("_key")).alias("id"), F.col(source_name).alias(name), *carry
    )
    return dimension.unionByName(created, allowMissingColumns=True)


def processed_ids(jobs: DataFrame) -> DataFrame:
    """Every source id that already belongs to a job."""
    return jobs.select(F.explode("source_ids").alias("source_id")).distinct()


def unprocessed(raw: DataFrame, jobs: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw rows whose source id no job carries yet.

    Ids are compared without their source.  Rows without an id are always
    unprocessed and skip the join.  ``limit`` takes the newest rows of a run.
    """
    with_id = raw.filter(F.col("source_id").isNotNull())
    left = (
        with_id.join(processed_ids(jobs), "source_id", "left_anti")
        .select(*raw.columns)
        .unionByName(raw.filter(F.col("source_id").isNull()))
    )
    if limit is None:
        return left
    return left.orderBy(F.col("ingested_at").desc_nulls_first(), "id").limit(limit)


def unclassified(jobs: DataFrame, limit: int | None = None) -> DataFrame:
    rows = jobs.filter(F.col("area").isNull())
    return rows if limit is None else rows.orderBy("job_id").limit(limit)


def with_description(jobs: DataFrame, raw: DataFrame) -> DataFrame:
    """Jobs with the description of their first source id.

    Of several raw rows with that id the earliest ingested one counts.  It is
    found among the short columns, with partial minima before the shuffle; its
    long text is then fetched by the raw row's own id, which no row shares.
    """
    keyed = jobs.withColumn("_first_id", F.try_element_at("source_ids", F.lit(1)))
    needed = keyed.select(F.col("_first_id").alias("source_id")).distinct()
    first = (
        raw.filter(F.col("source_id").isNotNull())
        .groupBy("source_id")
        .agg(F.min(F.struct("ingested_at", "id")).alias("_first"))
        .join(needed, "source_id", "left_semi")
        .select(F.col("source_id").alias("_first_id"), F.col("_first.id").alias("id"))
    )
    texts = raw.select("id", "description").join(first, "id").select("_first_id", "description")
    return keyed.join(texts, "_first_id", "left").drop("_first_id")


def location_or_default(location: Column) -> Column:
    """Missing and empty locations share one name."""
    return F.when(location == "", V.UNKNOWN_LOCATION).otherwise(
        F.coalesce(location, F.lit(V.UNKNOWN_LOCATION))
    )
