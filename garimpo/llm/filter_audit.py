"""Audit of document filters in every order: what each removes, alone and after the others.

A table-driven byte transducer reads each text once as UTF-8.  A byte's class gives
the next state (between words, within a word) and what is counted: code points,
capitals, symbols, word ends.  Its word spans go into an open-addressing hash table,
where two spans are one word only if their bytes are equal.  The rest is sums:
documents with the same outcomes behave alike in all orders, so the orders are read from
counts per set of failed filters.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import bodies, cuts, mixed, powers

FILTERS = "ABCDE"

# --- the transducer's tables ----------------------------------------------------
#: Byte classes: white space, first byte of another character, capital, symbol, later byte.
BLANK, FIRST, CAPITAL, SYMBOL, LATER = range(5)
CLASS = np.full(256, FIRST, dtype=np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
CLASS[ord("A") : ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = SYMBOL
CLASS[0x80:0xC0] = LATER
#: State after a byte of each class, whatever the state before: 0 between words, 1 within one.
#: The automaton is definite, so all bytes of a text can be stepped at once.
NEXT = np.array([0, 1, 1, 1, 1], dtype=np.int8)
#: What a byte of each class adds to the code points, capitals and symbols.
ADDS = np.array([[1, 0, 0], [1, 0, 0], [1, 1, 0], [1, 0, 1], [0, 0, 0]], dtype=np.uint8)


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sums, owner, start, end): code points, capitals and symbols of each text, and its word spans.

    No state crosses the border of two texts.
    """
    kinds = CLASS[data]
    sums = np.empty((len(offsets) - 1, 3), dtype=np.int64)
    for k in range(3):
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(ADDS[:, k][kinds], dtype=np.int64)))
        sums[:, k] = total[offsets[1:]] - total[offsets[:-1]]
    state = NEXT[kinds]
    begins = state.copy()
    begins[1:] &= ~state[:-1] & 1
    ends = state.copy()
    ends[:-1] &= ~state[1:] & 1
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = state[inner]
    ends[inner - 1] = state[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(offsets, start, side="right") - 1
    return sums, owner, start, end


def distinct_words(data: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, texts: int) -> np.ndarray:
    """Number of different words of each text: all spans enter one hash table together.

    A round lets every span claim its slot if it is free; a span whose slot holds an
    equal word of the same text is a repetition, any other goes on to the next slot.
    """
    count = np.zeros(texts, dtype=np.int64)
    if not len(start):
        return count
    size = end - start
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    windows = np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))
    whole = np.uint64(2**64 - 1)

    def part(spans: np.ndarray, at: int) -> np.ndarray:
        """Eight bytes of each span from place ``at``, zero beyond its end."""
        left = np.minimum(size[spans] - at, 8).astype(np.uint64)
        return windows[start[spans] + at] & (whole >> (np.uint64(64) - left * np.uint64(8)))

    everyone = np.arange(len(start))
    key = part(everyone, 0)
    multiplier = powers(0x9E3779B97F4A7C15, 9)
    longer = everyone[size > 8]
    for step in range(1, 8):
        key[longer] += part(longer, 8 * step) * multiplier[step]
        longer = longer[size[longer] > 8 * (step + 1)]
    body = memoryview(padded)
    for i in longer:  # beyond 64 bytes
        key[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(body[start[i] : end[i]], digest_size=8).digest(), "little"))
    key = mixed(key ^ (size.astype(np.uint64) << np.uint64(56))) ^ mixed(owner.astype(np.uint64), 1)

    mask = (1 << int(2 * len(start)).bit_length()) - 1
    slots = np.full(mask + 1, -1, dtype=np.int64)
    place = (key & np.uint64(mask)).astype(np.int64)
    open_ = everyone
    while len(open_):
        at = place[open_]
        free = slots[at] < 0
        slots[at[free]] = open_[free]
        held = slots[at]
        own = held == open_
        np.add.at(count, owner[open_[own]], 1)
        same = ~own & (key[held] == key[open_]) & (owner[held] == owner[open_]) & (size[held] == size[open_])
        a, b = held[same], open_[same]
        equal = np.ones(len(a), dtype=bool)
        left = np.arange(len(a))
        for step in range(8):
            left = left[size[a[left]] > 8 * step]
            if not len(left):
                break
            equal[left] &= part(a[left], 8 * step) == part(b[left], 8 * step)
            left = left[equal[left]]
        for i in left[size[a[left]] > 64]:
            equal[i] = body[start[a[i]] + 64 : end[a[i]]] == body[start[b[i]] + 64 : end[b[i]]]
        done = own
        done[np.flatnonzero(same)[equal]] = True
        open_ = open_[~done]
        place[open_] = (place[open_] + 1) & mask
    return count


def measure(documents: DataFrame, slice_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, lang, n_words, n_distinct, n_capitals, n_symbols, n_points, digest of every document.

    Texts are read whole; null is empty.  Counts are of UTF-8 bytes as they are, so a
    malformed text has as many code points as bytes that begin one.  ``digest`` is 128
    bits of the text.  A text longer than a slice is one slice.
    """

    def run(batches):
        for batch in batches:
            data, offsets = bodies(batch.column("text"))
            n = len(offsets) - 1
            numbers = np.zeros((n, 5), dtype=np.int64)
            digests = []
            for i, j in cuts(offsets, slice_bytes):
                here, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                sums, owner, start, end = transduce(here, at)
                numbers[i:j, 0] = np.bincount(owner, minlength=j - i)
                numbers[i:j, 1] = distinct_words(here, owner, start, end, j - i)
                numbers[i:j, 2], numbers[i:j, 3], numbers[i:j, 4] = sums[:, 1], sums[:, 2], sums[:, 0]
                body = memoryview(here)
                digests += (hashlib.blake2b(body[a:b], digest_size=16).digest() for a, b in zip(at, at[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *(pa.array(c) for c in numbers.T), pa.array(digests, pa.binary())],
                ["doc_id", "lang", "n_words", "n_distinct", "n_capitals", "n_symbols", "n_points", "digest"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(
        run,
        "doc_id long, lang string, n_words long, n_distinct long, n_capitals long, n_symbols long, n_points long, "
        "digest binary",
    )


def failed(min_words: int = 200, min_distinct: int = 50, max_capitals: int = 3) -> Column:
    """Bits of the failed filters A to D (A is bit 0); percentages are of words and code points."""
    conditions = [
        F.col("n_words") < min_words,
        F.col("n_distinct") * 100 < F.col("n_words") * min_distinct,
        F.col("n_capitals") * 100 > F.col("n_points") * max_capitals,
        F.col("n_symbols") > 0,
    ]
    return sum((c.cast("int") * (1 << k) for k, c in enumerate(conditions)), F.lit(0))


def outcomes(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of a part by the set of filters they fail.

    Filter E fails a document if one of smaller doc_id has the same text.  Rows with
    null doc_id never fail it and are nobody's smaller document; rows of one doc_id do
    not fail it for one another.  Several label rows of a document: one that says 1 counts.
    """
    measured = measure(documents).select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "digest", failed().alias("mask"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    known = measured.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # Rows of one document first, then equal texts of one part and label: a group of copies is a few rows.
    key = ["digest", "part", "mask", "good", "toxic"]
    rows = known.groupBy("doc_id", *key).agg(F.count("*").alias("rows"))
    groups = rows.groupBy(*key).agg(
        F.sum("rows").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("rows", "doc_id"), F.lit(0)).alias("at_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("unnamed"),
    )
    lowest = F.min("least").over(Window.partitionBy("digest"))
    single = F.col("unnamed") + F.when(F.col("least") == lowest, F.col("at_least")).otherwise(0)
    repeated = 1 << FILTERS.index("E")
    split = groups.withColumn("single", single).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), F.col("single").alias("n")),
            F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - F.col("single")).alias("n")),
        )).alias("x"),
    )
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters, and step.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, as counts of documents.  Parts are the values of ``lang``, null
    being the empty string.  No documents: no rows.  Texts and repeated rows are
    treated as in ``measure`` and ``outcomes``; other columns are ignored.
    """
    counted = outcomes(documents, labels)
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))  # 32 at most
    orders = ["".join(p) for p in permutations(FILTERS)]
    by_order = parts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
    steps = by_order.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = F.expr(f"transform(split(filter_order, ''), c -> shiftleft(1, instr('{FILTERS}', c) - 1))")
    ahead = F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda s, b: s + b)
    placed = steps.withColumn("bits", bits).withColumn("bit", F.expr("bits[step - 1]")).withColumn("ahead", ahead)

    def total(condition: str, of: str = "x.n") -> Column:
        return F.expr(f"aggregate(filter(sets, x -> {condition}), 0L, (s, x) -> s + {of})")

    fails, spared = "x.mask & bit <> 0", "x.mask & ahead = 0"
    first = f"{fails} and {spared}"
    # Every failed filter of a document comes first in an equal share of the orders.
    everywhere = f"cast({len(orders)} / bit_count(x.mask) as long) * x.n"
    return placed.select(
        "part", "filter_order", "step",
        total("x.mask & (ahead | bit) = 0").alias("kept"),
        total(first).alias("removed"),
        total(f"{fails} and x.mask & ahead <> 0").alias("redundant"),
        total("x.mask = bit").alias("unique_fails"),
        total(first, "x.good").alias("good_lost"),
        total(first, "x.toxic").alias("toxic_lost"),
        total(fails, everywhere).alias("shapley"),
    )
