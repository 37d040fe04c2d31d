"""Ordered rules and dictionaries as Column expressions.

Every list is a parameter; the defaults are the fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import fixed_values as V
from .text import (
    contains_any,
    count_contained,
    first_letters,
    first_match,
    fold,
    relabel,
    terms_overlap,
    word_pattern,
)


# --- area and seniority -------------------------------------------------------
def is_tech(title: Column, description: Column) -> Column:
    """Technology posting; both arguments folded."""
    return contains_any(title, V.TECH_TITLE_TERMS) | contains_any(
        description, V.TECH_DESCRIPTION_TERMS
    )


def is_data(title: Column, description: Column) -> Column:
    """Data posting; both arguments folded."""
    tools = count_contained(description, V.DATA_TOOLS) >= V.DATA_TOOLS_NEEDED
    context = contains_any(description, V.DATA_CONTEXT_TERMS)
    return contains_any(title, V.DATA_TITLE_TERMS) | (tools & context)


def area_from_folded(
    title: Column, description: Column, areas: Mapping[str, Sequence[str]] = V.AREA_TERMS
) -> Column:
    """``non_tech``, ``non_data``, the first area whose terms occur in the title, or NULL."""
    cases = [("non_tech", ~is_tech(title, description)), ("non_data", ~is_data(title, description))]
    cases += [(area, contains_any(title, terms)) for area, terms in areas.items()]
    return first_match(cases)


def area(title: Column, description: Column | None = None, **options) -> Column:
    description = F.lit("") if description is None else description
    return area_from_folded(fold(title), fold(description), **options)


def seniority_from_folded(
    title: Column, levels: Mapping[str, Sequence[str]] = V.SENIORITY_PATTERNS
) -> Column:
    """First level with a pattern between word boundaries, or NULL."""
    return first_match(
        [
            (level, title.rlike(first_letters(p) + r"\b(?:" + "|".join(p) + r")\b"))
            for level, p in levels.items()
        ]
    )


def seniority(title: Column, **options) -> Column:
    return seniority_from_folded(fold(title), **options)


def classification_source(area: Column, seniority: Column) -> Column:
    return F.when(area.isNotNull() | seniority.isNotNull(), "syntax").otherwise(V.UNKNOWN)


# --- dictionary terms ---------------------------------------------------------
def skills(
    description: Column,
    area: Column,
    by_area: Mapping[str, Sequence[str]] = V.SKILLS_BY_AREA,
    universal: Sequence[str] = tuple(V.UNIVERSAL_SKILLS),
) -> Column:
    """Dictionary terms found as whole words, in dictionary order, without repeats.

    The terms of the row's area come first, then the universal ones.  The text
    is scanned once with all terms, unless one term can hide another; then each
    term is searched for by itself.
    """
    lists = {name: list(dict.fromkeys([*terms, *universal])) for name, terms in by_area.items()}
    everything = list(dict.fromkeys(t for terms in [*lists.values(), universal] for t in terms))
    if not everything:
        return F.array().cast("array<string>")

    def choose(build) -> Column:
        chain = F.when(F.lit(False), build([]))
        for name, terms in lists.items():
            chain = chain.when(area == name, build(terms))
        return chain.otherwise(build(list(dict.fromkeys(universal))))

    if terms_overlap(everything):

        def matched(terms):
            hits = [F.when(description.rlike(word_pattern([t])), F.lit(t)) for t in terms]
            return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")

        found = choose(matched)
    else:
        seen = F.array_distinct(
            F.transform(
                F.regexp_extract_all(description, F.lit(word_pattern(everything)), F.lit(0)),
                lambda w: F.lower(F.upper(w)),
            )
        )

        def wanted(terms):
            return F.array(*[F.lit(t) for t in terms]).cast("array<string>")

        found = F.when(
            F.size(seen) > 0,
            F.filter(choose(wanted), lambda t: F.array_contains(seen, F.lower(F.upper(t)))),
        ).otherwise(F.array().cast("array<string>"))
    return F.coalesce(found, F.array().cast("array<string>"))


def all_known_skills(
    by_area: Mapping[str, Sequence[str]] = V.SKILLS_BY_AREA,
    universal: Sequence[str] = tuple(V.UNIVERSAL_SKILLS),
) -> list[str]:
    return list(dict.fromkeys(t for terms in [*by_area.values(), universal] for t in terms))


def new_terms(
    description: Column,
    known: Sequence[str] | None = None,
    stop_words: Sequence[str] = tuple(V.STOP_WORDS),
) -> Column:
    """Distinct capitalised tokens that are neither known terms nor stop words."""
    known = all_known_skills() if known is None else known
    skip = sorted({w.lower() for w in [*known, *stop_words]})
    tokens = F.transform(
        F.regexp_extract_all(description, F.lit("(?U)" + V.NEW_TERM_PATTERN), F.lit(0)),
        lambda w: F.btrim(w, F.lit(V.NEW_TERM_STRIP)),
    )
    kept = F.filter(
        F.array_distinct(tokens),
        lambda w: F.char_length(w).between(V.NEW_TERM_MIN, V.NEW_TERM_MAX)
        & ~F.lower(w).isin(skip),
    )
    return F.coalesce(kept, F.array().cast("array<string>"))


# --- work mode ----------------------------------------------------------------
def _says_remote(title: Column, location: Column, description: Column) -> Column:
    return (
        contains_any(title, V.REMOTE_TERMS)
        | contains_any(location, V.REMOTE_TERMS)
        | contains_any(description, V.REMOTE_PHRASES)
    )


def remote_at_load(title: Column, location: Column, description: Column, flag: Column) -> Column:
    """Remote flag completed from lower-cased (not accent-folded) texts."""
    lowered = [F.lower(F.coalesce(c, F.lit(""))) for c in (title, location, description)]
    return F.coalesce(flag, F.lit(False)) | _says_remote(*lowered)


def work_mode(title: Column, location: Column, description: Column, flag: Column) -> Column:
    """struct(is_remote, is_hybrid); hybrid wins over remote."""
    title, location, description = fold(title), fold(location), fold(description)
    remote = F.coalesce(flag, F.lit(False)) | _says_remote(title, location, description)
    hybrid = (
        contains_any(title, V.HYBRID_TERMS)
        | contains_any(location, V.HYBRID_TERMS)
        | contains_any(description, V.HYBRID_PHRASES)
        | (
            contains_any(description, V.HYBRID_TERMS)
            & ~contains_any(description, V.FULL_REMOTE_PHRASES)
        )
    )
    return F.struct((remote & ~hybrid).alias("is_remote"), hybrid.alias("is_hybrid"))


def remote_flag_text(value: Column) -> Column:
    """Remote flag given as text."""
    return F.coalesce(F.lower(value).isin(V.REMOTE_FLAG_VALUES), F.lit(False))


def mode_label(is_remote: Column, is_hybrid: Column, labels: Sequence[str]) -> Column:
    """Remote before hybrid before on-site."""
    remote, hybrid, onsite = labels
    return F.when(is_remote, remote).when(is_hybrid, hybrid).otherwise(onsite)


# --- expiry and external labels -----------------------------------------------
def page_is_active(
    status: Column, final_url: Column, html: Column, error: Column | None = None
) -> Column:
    """Whether a fetched page still shows an open posting.

    A failed fetch (error, or no status) never closes a posting.
    """
    url = F.lower(F.coalesce(final_url, F.lit("")))
    gone = status.isin(V.GONE_STATUS)
    moved = contains_any(url, V.EXPIRED_URL_PARTS)
    closed = (status == 200) & contains_any(fold(html), V.EXPIRED_PAGE_PHRASES)
    failed = status.isNull() if error is None else (status.isNull() | error.isNotNull())
    return failed | ~F.coalesce(gone | moved | closed, F.lit(False))


def checked_labels(
    response: Column,
    areas: Sequence[str] = tuple(V.VALID_AREAS),
    seniorities: Sequence[str] = tuple(V.VALID_SENIORITIES),
) -> Column:
    """struct(area, seniority) of a label response; NULL when it is not a JSON object.

    A missing key or a value outside the allowed set becomes ``unknown``.
    """
    answer = F.try_parse_json(F.btrim(response, F.lit(" \t\r\n")))
    is_object = F.schema_of_variant(answer).startswith("OBJECT")

    def guarded(key: str, allowed: Sequence[str]) -> Column:
        value = F.try_variant_get(answer, f"$.{key}", "string")
        return F.when(value.isin(list(allowed)), value).otherwise(V.UNKNOWN).alias(key)

    return F.when(
        is_object, F.struct(guarded("area", areas), guarded("seniority", seniorities))
    )


# --- gold rules ---------------------------------------------------------------
def country_code(
    location: Column, countries: Mapping[str, Sequence[str]] = V.COUNTRY_TERMS
) -> Column:
    """First country with a term in the location name, else the default."""
    name = F.lower(location)
    cases = [(code, contains_any(name, terms)) for code, terms in countries.items()]
    return first_match(cases, F.lit(V.DEFAULT_COUNTRY))


def country_name(code: Column) -> Column:
    return relabel(code, V.COUNTRY_NAMES, V.OTHER_COUNTRY_NAME)


def skill_category(
    skill: Column, categories: Mapping[str, Sequence[str]] = V.SKILL_CATEGORIES
) -> Column:
    name = F.lower(skill)
    cases = [(category, name.isin(list(terms))) for category, terms in categories.items()]
    return first_match(cases, F.lit(V.DEFAULT_CATEGORY))


def seniority_label(code: Column) -> Column:
    return relabel(code, V.SENIORITY_LABELS, V.OTHER_SENIORITY_LABEL)


def company_size(postings: Column) -> Column:
    cases = [(label, postings >= least) for least, label in V.COMPANY_SIZES]
    return first_match(cases, F.lit(V.SMALLEST_SIZE))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a decimal with one digit; NULL for an empty whole."""
    share = F.lit(100).cast("decimal(5,1)") * part.cast("decimal(19,0)")
    return F.round(share / F.nullif(whole.cast("decimal(19,0)"), F.lit(0)), 1).cast("decimal(20,1)")
