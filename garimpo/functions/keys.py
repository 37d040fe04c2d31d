"""Deterministic ids, so that a repeated run writes the same keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V

#: Every white-space character, ASCII or not.
WHITE_SPACE = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())


def surrogate_key(*columns: Column) -> Column:
    """md5 over the columns as text, with a placeholder for NULL."""
    parts = [F.coalesce(c.cast("string"), F.lit(V.NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def identity_hash(title: Column, company: Column, location: Column, window: Column) -> Column:
    """SHA-256 of a posting's identity; title and company come folded, location raw."""
    return F.sha2(F.concat_ws("|", title, company, location, window), 256)


def lookup_key(name: Column) -> Column:
    """The form in which company and location names are looked up, white space of any kind cut."""
    return F.btrim(F.lower(name), F.lit(WHITE_SPACE))


def natural_id(kind: str, *columns: Column) -> Column:
    """Stable id from a natural key."""
    return F.sha2(F.concat_ws("\x1f", F.lit(kind), *[c.cast("string") for c in columns]), 256)
