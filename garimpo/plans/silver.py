"""The silver steps: load, resolve, classify, label, expire.

Every step takes tables and returns new tables and a one-row counter frame.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.dates import older_than, since
from ..functions.keys import identity_hash, lookup_key, natural_id
from ..functions.rules import (
    all_known_skills,
    area_from_folded,
    checked_labels,
    classification_source,
    new_terms,
    page_is_active,
    seniority_from_folded,
    skills,
    work_mode,
)
from ..functions.text import fold
from ..operators.lookups import (
    get_or_create,
    jobs_with_names,
    location_or_default,
    name_map,
    unclassified,
    unprocessed,
    with_description,
)
from ..operators.merge import (
    append_to_array,
    insert_if_absent,
    new_rows,
    set_by_ids,
    set_where,
    update_by_key,
)
from ..operators.resolve import (
    Limits,
    assign_leaders,
    job_order,
    keyed_postings,
    merge_nodes,
    nodes,
    raw_order,
)
from ..session import checkpoint, counted, stored
from ..sources.mapping import map_all, with_own_ids


# --- load ---------------------------------------------------------------------
class Loaded(NamedTuple):
    raw: DataFrame
    per_source: DataFrame


def load(
    landing: DataFrame, raw: DataFrame, field_maps: Mapping[str, Mapping] = V.FIELD_MAPS, run: int | None = None
) -> Loaded:
    """Map landed postings and insert those whose (source, source_id) is not there yet.

    The mapped batch is stored once: a filter on a mapped column would otherwise
    be pushed below the mapping and parse every document again.

    ``run`` numbers the load.  Postings without source id are new in every run, but a run that is
    repeated after success gives them the ids they have, and inserts nothing twice.  Without a
    number the count of ``raw`` is taken, which tells further loads apart.
    """
    mapped = stored(map_all(landing, field_maps), "mapped")
    mapped = with_own_ids(mapped, raw.count() if run is None else run)
    keys, order = ["source", "source_id"], [F.col("ingested_at"), F.col("id"), F.col("payload")]
    fresh = new_rows(raw, mapped, keys, order, nullable_key="source_id")
    if run is not None:
        own = raw.filter(F.col("source_id").isNull()).select("id")
        fresh = fresh.join(own, "id", "left_anti").select(*fresh.columns)
    fresh, counts = counted(fresh, "fresh", {s: F.count_if(F.col("source") == s) for s in field_maps})
    pairs = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"`{s}`").alias("inserted")) for s in field_maps])
    per_source = counts.select(F.inline(pairs)).filter("inserted > 0")
    return Loaded(raw.unionByName(fresh, allowMissingColumns=True), per_source)


def load_totals(per_source: DataFrame, sources: list[str] = V.SOURCES) -> DataFrame:
    """One row: inserted rows of every source and their total."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("source") == s, F.col("inserted"))), F.lit(0)).alias(s)
        for s in sources
    ]
    return per_source.agg(*counts, F.coalesce(F.sum("inserted"), F.lit(0)).alias("total"))


# --- resolve ------------------------------------------------------------------
class Resolved(NamedTuple):
    jobs: DataFrame
    companies: DataFrame
    locations: DataFrame
    mapping: DataFrame
    stats: DataFrame


def resolve(
    raw: DataFrame,
    jobs: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
    run_at: str,
    limit: int | None = None,
    limits: Limits = Limits(),
) -> Resolved:
    """Attach unprocessed postings to known jobs or make new jobs of them.

    ``mapping`` has a row per posting (id, outcome, job_id): ``new``,
    ``duplicate`` or ``skipped`` (no title or company text).
    """
    # Long texts stay behind until a posting founds a job.
    thin = ["id", "source_id", "title", "company", "location", "posted_at", "ingested_at"]
    todo, taken = counted(unprocessed(raw.select(*thin), jobs, limit), "todo", {"taken": F.count(F.lit(1))})
    postings = keyed_postings(
        todo, "title", "company", "posted_at",
        raw_order(F.col("ingested_at"), F.col("id")), ["id", "source_id", "location"],
    )
    known = keyed_postings(
        jobs_with_names(jobs, companies, locations), "title", "company_name", "posted_at",
        job_order(F.col("created_at"), F.col("job_id")), ["job_id"],
    )
    graph = merge_nodes(nodes(known, True), nodes(postings, False))
    assigned = checkpoint(assign_leaders(graph, limits=limits))

    # Leaders: a known job under its id, a new one under the id of its identity.
    known_leaders = known.groupBy("kid").agg(F.min_by("job_id", "ord").alias("job_id"))
    identity = identity_hash(
        F.col("title_norm"), F.col("company_norm"), location_or_default(F.col("location")), F.col("window")
    )
    own = assigned.filter("kid = leader_kid").select("kid")
    firsts = nodes(postings, False).select("kid", F.col("ord").alias("first"))
    founders = (
        postings.join(own, "kid", "left_semi")
        .join(known_leaders, "kid", "left_anti")
        .join(firsts, "kid")
        .filter("ord = first")
        .select("id", "kid", identity.alias("dedup_hash"))
        .withColumn("job_id", natural_id("job", F.col("dedup_hash")))
    )
    founders = checkpoint(founders)
    leaders = known_leaders.unionByName(founders.select("kid", "job_id"))
    outcome = (
        postings.select("id", "source_id", "kid", "ord")
        .join(assigned, "kid")
        .join(leaders.withColumnRenamed("kid", "leader_kid"), "leader_kid")
        .join(founders.select("id", F.lit(True).alias("_founder")), "id", "left")
        .select(
            "id", "source_id", "ord", "job_id",
            F.when(F.col("_founder"), "new").otherwise("duplicate").alias("outcome"),
        )
    )
    named = {o: F.count_if(F.col("outcome") == o) for o in ("new", "duplicate")}
    outcome, counts = counted(outcome, "outcome", named)

    # New jobs, with the dimension rows they need.
    made = raw.join(founders.select("id", "job_id", "dedup_hash"), "id").select(
        "job_id", "dedup_hash", "title", "company", "url", "posted_at", "id", "ingested_at",
        location_or_default(F.col("location")).alias("raw"),
        F.when(F.col("source_id").isNotNull(), F.array("source_id"))
        .otherwise(F.array().cast("array<string>"))
        .alias("source_ids"),
        work_mode(F.col("title"), F.col("location"), F.col("description"), F.col("is_remote")).alias("mode"),
    ).select("*", "mode.is_remote", "mode.is_hybrid").drop("mode")
    made = checkpoint(made.withColumn("ord", raw_order(F.col("ingested_at"), F.col("id"))))
    all_companies = get_or_create(companies, made, "name", [F.col("ord")], "company", "company")
    all_locations = get_or_create(
        locations, made, "raw", [F.col("ord")], "location", carry=["is_remote"]
    )
    company_ids = name_map(all_companies, "name").toDF("_company", "company_id")
    location_ids = name_map(all_locations, "raw").toDF("_location", "location_id")
    new_jobs = (
        made.withColumn("_company", lookup_key(F.col("company")))
        .withColumn("_location", lookup_key(F.col("raw")))
        .join(company_ids, "_company", "left")
        .join(location_ids, "_location", "left")
        .select(
            "job_id", "source_ids", "dedup_hash", "title", "company_id", "location_id",
            F.array().cast("array<string>").alias("skills"),
            "url", "posted_at", "is_remote", "is_hybrid",
            F.lit(run_at).cast("timestamp").alias("created_at"),
            F.lit(True).alias("is_active"),
        )
    )
    inserted = insert_if_absent(jobs, new_jobs, ["dedup_hash"], [F.col("job_id")])
    additions = outcome.filter("outcome = 'duplicate'").select(
        "job_id", F.coalesce("source_id", "id").alias("item"), "ord"
    )
    merged = append_to_array(inserted, additions, "job_id", "source_ids", "item", "ord")

    mapping = todo.select("id").join(outcome.select("id", "outcome", "job_id"), "id", "left").select(
        "id", F.coalesce("outcome", F.lit("skipped")).alias("outcome"), "job_id"
    )
    # Both are one row of counters taken while the rows were written.
    stats = counts.join(F.broadcast(taken), F.lit(True)).select(
        "new", "duplicate", (F.col("taken") - F.col("new") - F.col("duplicate")).alias("skipped")
    )
    return Resolved(merged, all_companies, all_locations, mapping, stats)


# --- classify -----------------------------------------------------------------
class Classified(NamedTuple):
    jobs: DataFrame
    unmapped: DataFrame
    stats: DataFrame


def classified_rows(
    rows: DataFrame,
    areas: Mapping = V.AREA_TERMS,
    levels: Mapping = V.SENIORITY_PATTERNS,
    by_area: Mapping = V.SKILLS_BY_AREA,
    universal: list[str] = V.UNIVERSAL_SKILLS,
    known: list[str] | None = None,
) -> DataFrame:
    """(job_id, area, seniority, skills, classification_source, new_terms) of (job_id, title, description).

    ``area`` and ``seniority`` are NULL where no rule matched.  Texts are folded
    once; every rule reads the folded columns.
    """
    known = all_known_skills(by_area, universal) if known is None else known
    folded = rows.select(
        "job_id", "description",
        fold(F.col("title")).alias("_title"), fold(F.col("description")).alias("_description"),
    )
    ruled = folded.select(
        "job_id", "description",
        area_from_folded(F.col("_title"), F.col("_description"), areas).alias("area"),
        seniority_from_folded(F.col("_title"), levels).alias("seniority"),
    )
    return ruled.select(
        "job_id", "area", "seniority",
        skills(F.col("description"), F.col("area"), by_area, universal).alias("skills"),
        classification_source(F.col("area"), F.col("seniority")).alias("classification_source"),
        new_terms(F.col("description"), known).alias("new_terms"),
    )


def classify(jobs: DataFrame, raw: DataFrame, run_at: str, limit: int | None = None, **rules) -> Classified:
    """Classify the jobs without area; log capitalised terms that no dictionary knows."""
    rows = with_description(unclassified(jobs, limit), raw).select("job_id", "title", "description")
    counters = {
        "classified": F.count(F.lit(1)),
        "area_unknown": F.count_if(F.col("area").isNull()),
        "seniority_unknown": F.count_if(F.col("seniority").isNull()),
    }
    ruled, stats = counted(classified_rows(rows, **rules), "ruled", counters)
    changes = ruled.select(
        "job_id",
        F.coalesce("area", F.lit(V.UNKNOWN)).alias("area"),
        F.coalesce("seniority", F.lit(V.UNKNOWN)).alias("seniority"),
        "skills", "classification_source",
    )
    unmapped = ruled.select(
        "job_id", F.explode("new_terms").alias("word"), F.lit(run_at).cast("timestamp").alias("occurred_at")
    )
    return Classified(
        update_by_key(jobs, changes, "job_id", ["area", "seniority", "skills", "classification_source"]),
        unmapped,
        stats,
    )


# --- external labels ----------------------------------------------------------
class Labelled(NamedTuple):
    jobs: DataFrame
    stats: DataFrame


def unknown_active(jobs: DataFrame, as_of: str) -> DataFrame:
    """Recent active jobs whose area or seniority the rules did not find."""
    return jobs.filter(
        F.col("is_active")
        & since(F.col("posted_at"), V.EXPIRY_DAYS, as_of)
        & (F.col("classification_source") == V.UNKNOWN)
        & ((F.col("area") == V.UNKNOWN) | (F.col("seniority") == V.UNKNOWN))
    )


def label_outcomes(jobs: DataFrame, responses: DataFrame, as_of: str) -> DataFrame:
    """(job_id, area, seniority, success) for every answered candidate."""
    answered = unknown_active(jobs, as_of).select("job_id").join(responses, "job_id")
    labels = answered.select("job_id", checked_labels(F.col("response")).alias("labels"))
    known = (F.col("labels.area") != V.UNKNOWN) | (F.col("labels.seniority") != V.UNKNOWN)
    return labels.select(
        "job_id", "labels.area", "labels.seniority", F.coalesce(known, F.lit(False)).alias("success")
    )


def apply_labels(jobs: DataFrame, responses: DataFrame, as_of: str) -> Labelled:
    """Take over usable label responses; skills stay, the source becomes ``ia``."""
    counters = {
        "processed": F.count(F.lit(1)), "success": F.count_if("success"), "failed": F.count_if(~F.col("success")),
    }
    outcomes, stats = counted(label_outcomes(jobs, responses, as_of), "labels", counters)
    changes = outcomes.filter("success").withColumn("classification_source", F.lit("ia"))
    columns = ["area", "seniority", "classification_source"]
    return Labelled(update_by_key(jobs, changes, "job_id", columns), stats)


# --- expire -------------------------------------------------------------------
class Expired(NamedTuple):
    jobs: DataFrame
    stats: DataFrame


def active_recent(jobs: DataFrame, as_of: str) -> DataFrame:
    """Active jobs young enough for a link check."""
    return jobs.filter(F.col("is_active") & since(F.col("posted_at"), V.EXPIRY_DAYS, as_of))


def closed_ids(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """Ids of jobs with a link whose fetched page no longer shows an open posting."""
    linked = jobs.filter(F.col("url").isNotNull() & (F.col("url") != "")).select("job_id")
    closed = pages.filter(
        ~page_is_active(F.col("status_code"), F.col("final_url"), F.col("html"), F.col("error"))
    ).select("job_id")
    return closed.join(linked, "job_id", "left_semi").distinct()


def expire(jobs: DataFrame, pages: DataFrame, as_of: str) -> Expired:
    """Deactivate old jobs, then the recent ones whose page is closed.

    A job without date is neither old nor recent.
    """
    too_old = F.col("is_active") & older_than(F.col("posted_at"), V.EXPIRY_DAYS, as_of)
    aged = set_where(jobs, too_old, {"is_active": F.lit(False)})
    recent = active_recent(jobs, as_of)
    ids, by_link = counted(closed_ids(recent, pages), "closed", {"expired_by_link": F.count(F.lit(1))})
    counts = jobs.agg(
        F.count_if(too_old).alias("expired_by_age"),
        F.count_if(F.col("is_active") & since(F.col("posted_at"), V.EXPIRY_DAYS, as_of)).alias("tested"),
    )
    # Both sides are one row.
    stats = counts.join(F.broadcast(by_link), F.lit(True))
    return Expired(set_by_ids(aged, ids, "job_id", {"is_active": F.lit(False)}), stats)
