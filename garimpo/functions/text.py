"""Text expressions that stay inside the JVM."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, functions as F

# White space that may frame a folded (ASCII) text.
ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


@cache
def _accents() -> tuple[str, str]:
    """Every character whose canonical decomposition keeps an ASCII letter or sign."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        plain = unicodedata.normalize("NFD", chr(code)).encode("ascii", "ignore").decode()
        if plain:
            source.append(chr(code))
            target.append(plain)
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Accent-free lower-case ASCII; NULL becomes the empty string.

    Pure ASCII texts (one byte per character) skip the translation.
    """
    text = F.coalesce(text, F.lit(""))
    source, target = _accents()
    plain = F.regexp_replace(F.translate(text, source, target), r"[^\x00-\x7F]", "")
    return F.lower(F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain))


def fold_strip(text: Column) -> Column:
    """``fold`` without framing white space: the form compared by entity resolution."""
    return F.btrim(fold(text), F.lit(ASCII_SPACE))


def sort_tokens(text: Column) -> Column:
    """The words of a folded text in sorted order, joined by single spaces."""
    # No lambdas, which Spark interprets row by row; a pattern of one plain character is no regex to Java.
    words = F.when(text.rlike(r"[\t-\r\x1c-\x1f]"), F.split(text, r"[\s\x1c-\x1f]+")).otherwise(F.split(text, " "))
    several = F.array_join(F.sort_array(F.array_remove(words, "")), " ")
    return F.when(text.rlike(r"[\s\x1c-\x1f]"), several).otherwise(text)


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when at least one term occurs as a substring: short-circuited byte searches.

    A term that contains another one decides nothing and is left out; short
    terms, which hit most often, come first.
    """
    distinct = set(terms)
    deciding = [t for t in distinct if not any(o != t and o in t for o in distinct)]
    found = F.lit(False)
    for term in sorted(deciding, key=lambda t: (len(t), t)):
        found = found | text.contains(term)
    return found


def count_contained(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur as substrings."""
    total = F.lit(0)
    for term in terms:
        total = total + text.contains(term).cast("int")
    return total


def first_match(cases: Sequence[tuple[str, Column]], default: Column | None = None) -> Column:
    """Value of the first condition that holds, in the given order."""
    chain = None
    for value, condition in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        raise ValueError("first_match needs at least one case")
    return chain if default is None else chain.otherwise(default)


def relabel(code: Column, labels: dict[str, str], default: str) -> Column:
    """Replace a code by its label."""
    return first_match([(label, code == key) for key, label in labels.items()], F.lit(default))


def blank_to(text: Column, fallback: str) -> Column:
    """Fallback for NULL, empty and all-space values."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(fallback))


def first_letters(patterns: Sequence[str]) -> str:
    """A look-ahead that skips positions where no pattern can start."""
    letters = sorted({p[0] for p in patterns})
    return f"(?=[{''.join(letters)}])" if all(c.isalnum() for c in letters) else ""


def word_pattern(terms: Sequence[str]) -> str:
    """A case-insensitive, Unicode-aware alternation of whole words."""
    quoted = "|".join(r"\Q" + t + r"\E" for t in terms)
    return rf"(?iU){first_letters(terms)}\b(?:{quoted})\b"


def terms_overlap(terms: Sequence[str]) -> bool:
    """Whether one term can hide another in a left-to-right scan."""
    split = [re.findall(r"\w+", t.lower()) for t in terms]
    for a in split:
        for b in split:
            if a == b:
                continue
            inside = any(b[i : i + len(a)] == a for i in range(len(b)))
            chained = any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) + 1))
            if inside or chained:
                return True
    return False
