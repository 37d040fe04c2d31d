"""Parsing of scraped result cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.keys import WHITE_SPACE
from ..functions.text import contains_any
from .mapping import as_id, nested


def card_lines(text: Column) -> Column:
    """Trimmed non-blank lines."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE_SPACE)))
    return F.filter(lines, lambda line: line != "")


def absolute_url(url: Column, base: str = V.CARD_BASE_URL) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url)


def url_token(url: Column, marker: str = "job") -> Column:
    """The path segment after ``marker``, or NULL."""
    path = F.btrim(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1), F.lit("/"))
    parts = F.split(path, "/")
    place = F.array_position(parts, marker)
    return F.when(place > 0, F.try_element_at(parts, (place + 1).cast("int")))


def token_id(token: Column) -> Column:
    """Id inside a base64 JSON token; a token that does not decode is the id itself."""
    padded = F.rpad(token, (F.ceil(F.char_length(token) / 4) * 4).cast("int"), "=")
    text = F.try_validate_utf8(
        F.try_to_binary(F.regexp_replace(padded, "[^A-Za-z0-9+/=]", ""), F.lit("base64")).cast("string")
    )
    document = F.try_parse_json(text)
    is_object = F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, as_id(nested(document, "jobId", "variant"))).otherwise(token)


def card_source_id(url: Column) -> Column:
    return token_id(url_token(url))


def parse_cards(cards: DataFrame, text: str = "raw_text", url: str = "url") -> DataFrame:
    """Company, title and location are the first three lines of a card that has three."""
    lines = F.col("lines")
    enough = F.size(lines) >= 3
    return (
        cards.withColumn("lines", card_lines(F.col(text)))
        .withColumn("url", absolute_url(F.col(url)))
        .withColumn("company", F.when(enough, F.try_element_at(lines, F.lit(1))))
        .withColumn("title", F.when(enough, F.try_element_at(lines, F.lit(2))))
        .withColumn("location", F.when(enough, F.try_element_at(lines, F.lit(3))))
        .withColumn("source_id", card_source_id(F.col("url")))
        .withColumn("is_remote", remote_card(F.col("location")))
    )


def remote_card(location: Column) -> Column:
    return contains_any(F.lower(F.coalesce(location, F.lit(""))), V.CARD_REMOTE_TERMS)
