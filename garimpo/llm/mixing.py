"""Mixing of sources to target weights by capped water-filling.

Sources share a number of words by weight.  A target above a source's maximal number of
epochs is clamped there, and what it leaves is shared again by weight, until no target is
above.  A source's target is then whole repetitions of all its documents and one
fractional repetition: its documents in a seeded order, as far as the words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filter_audit import BLANK, CLASS
from .shared import bodies, cuts, written

#: Leading hexadecimal digits of a key: the cells in which the end of a fractional repetition is sought.
CELL_DIGITS = 4


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the first bytes of words; a text's border ends a word."""
    word = CLASS[data] != BLANK
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[offsets < len(data)]
    begins[inner] = word[inner]
    return np.flatnonzero(begins)


def measured(documents: DataFrame, seed: str = "mix", with_text: bool = False, slice_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, source, size and mix_key of every document, and its text if wanted.

    ``size`` counts words: runs of bytes other than ASCII white space; a null text has none.
    The key is the MD5 of seed, doc_id and text, so rows without doc_id are spread as well.
    """

    def run(batches):
        for batch in batches:
            data, offsets = bodies(batch.column("text"))
            sizes = np.zeros(len(batch), dtype=np.int64)
            for i, j in cuts(offsets, slice_bytes):
                here, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                sizes[i:j] = np.diff(np.searchsorted(_word_starts(here, at), at))
            body, keys = memoryview(data), []
            for name, a, b in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:]):
                made = hashlib.md5(f"{seed}:{'' if name is None else name}:".encode(), usedforsecurity=False)
                made.update(body[a:b])
                keys.append(made.hexdigest())
            held = batch if with_text else batch.select(["doc_id", "source"])
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(sizes), pa.array(keys, pa.string())], [*held.schema.names, "size", "mix_key"]
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, f"doc_id long, source string, {'text string, ' if with_text else ''}size long, mix_key string")


def _ranked(sources: DataFrame) -> DataFrame:
    """The sources with ``rank`` from 0 by code point, null last; no task sees all of them."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    ordered = written(ordered.withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    bases = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    named = ordered.withColumn("part", part).join(bases, "part")
    return named.withColumn("rank", F.col("base") + F.col("place").bitwiseAND(2**33 - 1)).drop("place", "part", "base")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``target`` of each source: rows (source, source_size, weight) are kept.

    ``share`` times all sizes is dealt by weight.  A round clamps the targets above
    ``max_epochs`` times their source's size; one that clamps nothing is the last.
    If all are clamped, the mix is as large as they allow.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    state = written(sources.withColumn("clamped", F.lit(False)), "sources")
    total = state.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * float(share)
    while True:
        capped, weight = state.agg(
            F.coalesce(F.sum(F.when(F.col("clamped"), cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~F.col("clamped"), F.col("weight"))), F.lit(0)),
        ).first()
        left = max(0.0, total - capped)
        above = ~F.col("clamped") & (F.lit(left) * F.col("weight") > cap * F.lit(weight))
        if weight == 0 or state.where(above).isEmpty():
            break
        state = written(state.withColumn("clamped", F.col("clamped") | above), "sources")
    target = F.when(F.col("clamped"), cap).otherwise(F.lit(left) * F.col("weight") / F.lit(float(weight or 1)))
    return state.withColumn("target", target).drop("clamped")


def source_plan(
    rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """What to take of each source, from the rows of ``measured``.

    source, source_size, weight, target, whole, extra, end_key, end_words, end_rows:
    ``whole`` repetitions of all documents and ``extra`` words more, which are the documents with
    keys before ``end_key`` and ``end_words`` of those with that key (``end_rows`` of them).
    Ranks of sources by code point repeat the weights.  Sources without words have target 0.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = water_fill(_ranked(sizes).withColumn("weight", weight).drop("rank"), share, max_epochs)
    words = F.floor("target")
    plan = filled.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)))
    plan = written(plan.withColumn("extra", words - F.col("whole") * F.col("source_size")), "plan")

    # The cell in which the extra words end, from the sums of at most 16 ** CELL_DIGITS cells a source.
    cell = F.substring("mix_key", 1, CELL_DIGITS)
    cells = rows.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("words"))
    ended = _end(cells, plan.select("source", "extra"), "cell")
    # Then the key within it.
    inside = rows.withColumn("cell", cell).join(
        _bounded(written(ended.select(F.col("source").alias("_source"), F.col("cell").alias("_cell"), "left"), "ends")),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")),
    )
    keys = inside.groupBy("source", "mix_key", F.col("left").alias("extra")).agg(
        F.sum("size").alias("words"), F.count("*").alias("end_rows")
    )
    last = _end(keys.drop("extra"), keys.select("source", "extra").distinct(), "mix_key")
    ends = last.select(
        F.col("source").alias("_source"), F.col("mix_key").alias("end_key"), F.col("left").alias("end_words"), "end_rows"
    )
    return written(plan.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"), "plan")


def _bounded(sources: DataFrame, most: int = 100_000) -> DataFrame:
    """A table of one row a source, broadcast if it is as small as that; beyond, joins shuffle and split hot sources."""
    return F.broadcast(sources) if sources.limit(most + 1).count() <= most else sources


def _end(parts: DataFrame, wanted: DataFrame, order: str) -> DataFrame:
    """The part of each source in which its ``extra`` words end, and the words ``left`` for it."""
    line = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumn("before", F.coalesce(F.sum("words").over(line), F.lit(0)))
    wanted = wanted.select(F.col("source").alias("_source"), "extra")
    met = summed.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    ends = (F.col("before") < F.col("extra")) & (F.col("before") + F.col("words") >= F.col("extra"))
    return met.where(ends).withColumn("left", F.col("extra") - F.col("before")).drop("_source")


def _decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their source's plan, ``whole`` and ``extra`` (words of the fractional repetition)."""
    plan = plan.select(
        F.col("source").alias("_source"), "source_size", "target", "whole", "end_key", "end_words", "end_rows"
    )
    met = rows.join(_bounded(plan), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part = F.when(F.col("mix_key") < F.col("end_key"), F.col("size"))
    part = part.when(F.col("mix_key") == F.col("end_key"), F.floor(F.col("end_words") / F.col("end_rows"))).otherwise(F.lit(0))
    return met.withColumn("extra", part).drop("end_key", "end_words", "end_rows")


def mix(
    documents: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken, source, whole.

    One row per document.  ``taken`` is ``whole`` repetitions and the words of the
    fractional one; a source's sum is its target without the fraction of a word.  Null texts have
    size 0; null sources are one source.  Equal rows of one doc_id share what ends among them
    equally.  No documents: no rows.  Reruns with one seed agree whatever the partitions.
    """
    rows = written(measured(documents, seed), "measured")
    return _decided(rows, source_plan(rows, weights, share, max_epochs)).select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"), "source", "whole"
    )


def mixture(
    documents: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """The mixed texts: doc_id, source, repetition, text; a cut repetition holds the first words.

    Texts stay where they are read; only sizes and keys are shuffled.  Documents that are not
    taken have no row; those without words have one per whole repetition.
    """
    rows = written(measured(documents, seed), "measured")
    plan = source_plan(rows, weights, share, max_epochs)
    decided = _decided(measured(documents, seed, with_text=True), plan)
    taken = decided.where("whole > 0 or extra > 0").withColumn(
        "repetition", F.explode(F.expr("sequence(1L, whole + if(extra > 0, 1, 0))"))
    )
    words = F.when(F.col("repetition") <= F.col("whole"), F.col("size")).otherwise(F.col("extra"))
    cut = taken.select("doc_id", "source", "repetition", "text", "size", words.alias("words"))

    def run(batches):
        for batch in batches:
            data, offsets = bodies(batch.column("text"))
            texts = []
            for i, (size, wanted) in enumerate(zip(batch.column("size").to_pylist(), batch.column("words").to_pylist())):
                body = data[offsets[i] : offsets[i + 1]]
                if wanted < size:
                    body = body[: _word_starts(body, np.zeros(1, np.int64))[wanted]]
                texts.append(body.tobytes().rstrip(b" \t\n\v\f\r") if wanted < size else body.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "source", "repetition"]).columns, pa.array(texts, pa.binary())],
                ["doc_id", "source", "repetition", "body"],
            )

    mixed = cut.mapInArrow(run, "doc_id long, source string, repetition long, body binary")
    return mixed.select("doc_id", "source", "repetition", F.col("body").cast("string").alias("text"))
