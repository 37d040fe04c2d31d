"""Per-source field maps: from a JSON posting to the common raw schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.dates import epoch_date, parse_date
from ..functions.keys import natural_id
from ..functions.rules import remote_at_load, remote_flag_text

NUMBERS = ["BIGINT", "DOUBLE", "FLOAT"]


def nested(document: Column, path: str, kind: str = "string") -> Column:
    """Value under a dotted path; NULL when a level is missing or not an object."""
    steps = "".join(f"['{step}']" for step in path.split("."))
    return F.try_variant_get(document, "$" + steps, kind)


def _kind(value: Column) -> Column:
    """BOOLEAN, STRING, BIGINT, DECIMAL(..), ... of a variant."""
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_number(value: Column) -> Column:
    return _kind(value).isin(NUMBERS) | _kind(value).startswith("DECIMAL")


def as_date_value(value: Column) -> Column:
    """Date of an epoch number or of a date text."""
    return F.when(_is_number(value), epoch_date(F.try_variant_get(value, "$", "double"))).when(
        _kind(value) == "STRING", parse_date(_text(value))
    )


def as_id(value: Column) -> Column:
    """Text of an id; empty text, zero and false count as missing."""
    empty = (
        (_text(value) == "")
        | ((_kind(value) == "BOOLEAN") & (_text(value) == "false"))
        | (_is_number(value) & (F.try_variant_get(value, "$", "double") == 0))
    )
    return F.when(~empty, _text(value))


def as_flag(value: Column) -> Column:
    """True for JSON true and for the remote words."""
    return F.when(_kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).otherwise(
        (_kind(value) == "STRING") & remote_flag_text(_text(value))
    )


def map_all(
    records: DataFrame, field_maps: Mapping[str, Mapping] = V.FIELD_MAPS, payload: str = "payload"
) -> DataFrame:
    """Postings of every source in the common raw schema, in one pass.

    ``records`` has the posting as JSON text in ``payload``, names its source in
    ``source`` and may carry ``ingested_at``.  The JSON is parsed once per row;
    the source decides which paths are read.  Rows of other sources are left out.
    """
    kept = [c for c in ("ingested_at", "place") if c in records.columns]
    source = F.col("source")
    fields = ["source_id", "title", "company", "location", "description", "url", "posted_at"]
    flags = {name: m["is_remote"] for name, m in field_maps.items()}
    always = [name for name, path in flags.items() if path is True]

    def picked(paths: Mapping[str, str]) -> Column:
        """The value at each source's own path."""
        return first_match_of(
            [(source == name, nested(F.col("_document"), path, "variant")) for name, path in paths.items()]
        )

    parsed = records.filter(source.isin(list(field_maps))).select(
        "source", F.col(payload).alias("payload"), *kept,
        F.try_parse_json(F.col(payload)).alias("_document"),
    )
    values = parsed.select(
        "source", "payload", *kept,
        *[picked({n: m[field] for n, m in field_maps.items()}).alias(field) for field in fields],
        picked({n: path for n, path in flags.items() if isinstance(path, str)}).alias("_flag"),
    )
    typed = values.select(
        "source",
        as_id(F.col("source_id")).alias("source_id"),
        *[_text(F.col(name)).alias(name) for name in fields[1:6]],
        as_date_value(F.col("posted_at")).alias("posted_at"),
        (source.isin(always) | F.coalesce(as_flag(F.col("_flag")), F.lit(False))).alias("_flag"),
        "payload",
        *kept,
    )
    return typed.select(
        natural_id("raw", source, F.coalesce("source_id", F.md5("payload"))).alias("id"),
        "source",
        *fields,
        remote_at_load(
            F.col("title"), F.col("location"), F.col("description"), F.col("_flag")
        ).alias("is_remote"),
        "payload",
        *kept,
    )


def with_own_ids(mapped: DataFrame, run: int) -> DataFrame:
    """Postings without source id get an id of their own: equal ones are different postings.

    The id is a hash of the posting, its load time, its place and ``run``, a number that
    a repeated run has again and a further run has not.  The place is the column ``place``, a file and a
    row within it (see ``read_landing``); without that column it is the posting's number among its
    equals.  Neither depends on how a scan is split or how many cores read it.
    """
    parts = [F.col("source"), F.md5("payload"), F.col("ingested_at"), F.lit(run), F.col("place")]
    if "place" in mapped.columns:
        own = natural_id("own", *parts)
        return mapped.withColumn("id", F.when(F.col("source_id").isNull(), own).otherwise(F.col("id"))).drop("place")
    equals = Window.partitionBy("source", F.md5("payload"), "ingested_at").orderBy(F.lit(0))
    bare = mapped.filter(F.col("source_id").isNull()).withColumn("place", F.row_number().over(equals))
    bare = bare.withColumn("id", natural_id("own", *parts)).select(*mapped.columns)
    return bare.unionByName(mapped.filter(F.col("source_id").isNotNull()))


def first_match_of(cases: list[tuple[Column, Column]]) -> Column:
    """Value of the first condition that holds, both as columns; NULL without cases."""
    if not cases:
        return F.lit(None).cast("variant")
    (condition, value), *rest = cases
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain
