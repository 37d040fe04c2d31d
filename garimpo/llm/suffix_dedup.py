"""Removal of long byte strings that occur more than once in a corpus.

Every 200-byte string names an anchor: the place of the least hash among its
16-byte grams.  Equal strings name equal anchors at equal offsets, so runs of strings with
one anchor ("pieces") can only repeat among pieces of the same anchor hash.
Anchors that occur once, and anchors whose pieces are all equal, are settled by
counting.  A string reaches far to one side of its anchor at least, so a piece whose neighbourhoods
there no other piece has cannot repeat.  The other pieces are dealt into buckets, and the suffix order of a bucket's
batches, each some whole anchors, is built column by column: one symbol of every piece a round, inserted into the
collection's Burrows-Wheeler transform and common-prefix column, both read and written
in one sequential sweep.  Anchors of very many different pieces are no batch: their strings are
dealt by what they hold and counted.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mixed, powers, slices, written

GRAM = 16
BASE = 0xC6A4A7935BD1E995


def cut(texts: list[bytes], width: int = 200):
    """Pieces of the texts: (text, start, strings, anchor hash, content hash, left, right) arrays.

    ``left`` and ``right`` are hashes of the anchor's gram with the bytes before and after it,
    half of what a string has besides the gram; 0 where a piece does not reach that far.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    n, window = len(data), width - GRAM + 1
    if n < width:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 4
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    back = powers(pow(BASE, -1, 2**64), n)
    gram = mixed((total[GRAM:] - total[:-GRAM]) * back[: n - GRAM + 1], 50)
    low = gram >> np.uint64(32) << np.uint64(32) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while span * 2 <= window:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if window > span:
        low = np.minimum(low[: len(low) - (window - span)], low[window - span :])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the string at each place
    text = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + width <= ends[text]
    turn = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    place = np.flatnonzero(turn & whole)
    # A run ends where the anchor turns or the text has no further whole string.
    stop = np.r_[np.flatnonzero(turn), len(anchor)]
    stop = stop[np.searchsorted(stop, place, side="right")]
    stop = np.minimum(stop, ends[text[place]] - width + 1)
    content = (total[stop + width - 1] - total[place]) * back[place] + (stop - place).astype(np.uint64)
    starts = ends - sizes
    half = window // 2  # of two neighbourhoods of this length each string holds one
    at = anchor[place]
    sides = []
    for low, high, seed in ((at - half, at + GRAM, 8), (at, at + GRAM + half, 9)):
        inside = (low >= place) & (high <= stop + width - 1)
        low, high = np.where(inside, low, 0), np.where(inside, high, 0)
        sides.append(np.where(inside, mixed((total[high] - total[low]) * back[low], seed) | np.uint64(1), np.uint64(0)))
    return text[place], place - starts[text[place]], stop - place, gram[at], mixed(content, 7), *sides


def repeated(pieces: list[bytes], width: int = 200) -> list[np.ndarray]:
    """For each of some distinct pieces: which of its ``width``-byte strings occur elsewhere in them.

    A symbol is eight bytes (four, two or one if ``width`` is no multiple), so a piece gives
    eight strings of symbols, one from each of its first eight places.  Round j inserts the suffixes of
    j symbols of all strings.  ``marks`` holds the symbol before each suffix in suffix
    order, ``common`` the number of symbols a suffix shares with the one before it.
    """
    unit = next(u for u in (8, 4, 2, 1) if width % u == 0)
    span = width // unit
    length = np.array([len(p) for p in pieces], dtype=np.int64)
    begin = np.cumsum(length) - length
    data = np.frombuffer(b"".join(pieces) + bytes(unit), dtype=np.uint8).astype(np.uint64)
    window = sum(data[k : len(data) - unit + k] << np.uint64(8 * k) for k in range(unit))
    values, codes = np.unique(window, return_inverse=True)
    kind = np.uint16 if len(values) < 2**16 else np.uint32
    end = len(values)  # marks a whole string
    size = np.concatenate([np.maximum(length - r, 0) // unit for r in range(unit)])
    origin = np.concatenate([begin + r for r in range(unit)])
    count, longest = len(size), int(size.max(initial=0))
    back = size[None, :] - 1 - np.arange(longest + 1)[:, None]  # row j: the symbol before the suffix of j symbols
    symbols = np.where(back >= 0, codes[np.maximum(origin + back * unit, 0) % max(len(codes), 1)], end).astype(kind)
    marks, common = symbols[0].copy(), np.zeros(count, dtype=np.uint8 if span < 256 else np.uint32)
    at = np.arange(count)
    for j in range(1, longest + 1):
        live = np.flatnonzero(size >= j)
        live = live[np.argsort(at[live])]
        here = at[live]
        order = np.argsort(marks, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[here]
        symbol = marks[here]
        before, after = order[np.maximum(rank - 1, 0)], order[np.minimum(rank + 1, len(order) - 1)]
        has_before = (rank > 0) & (marks[before] == symbol)
        has_after = (rank + 1 < len(order)) & (marks[after] == symbol)
        ranges = np.empty(2 * len(live), dtype=np.int64)
        padded = np.append(common, common.dtype.type(0))
        ranges[0::2], ranges[1::2] = np.where(has_before, before + 1, here), here + 1
        with_before = np.where(has_before, np.minimum(np.minimum.reduceat(padded, ranges)[::2], span - 1) + 1, 0)
        ranges[0::2], ranges[1::2] = here + 1, np.where(has_after, after + 1, here + 1)
        with_after = np.where(has_after, np.minimum(np.minimum.reduceat(padded, ranges)[::2], span - 1) + 1, 0)
        new = count + rank
        old = np.ones(len(marks) + len(live), dtype=bool)
        old[new] = False
        grown, shared = np.empty(len(old), dtype=kind), np.zeros(len(old) + 1, dtype=common.dtype)
        grown[old], shared[:-1][old] = marks, common
        grown[new] = symbols[j][live]
        shared[new + 1] = with_after
        shared[new] = with_before
        marks, common = grown, shared[:-1]
        at[live] = new
    order = np.argsort(marks, kind="stable")
    step = np.empty(len(order), dtype=np.int64)
    step[order] = count + np.arange(len(order))
    twin = np.append(common, common.dtype.type(0)) >= span
    twin = twin[:-1] | twin[1:]
    flags = np.zeros(len(data), dtype=bool)
    at = np.arange(count)
    for j in range(1, longest + 1):
        live = np.flatnonzero(size >= j)
        at[live] = step[at[live]]
        if j >= span:
            hit = live[twin[at[live]]]
            flags[origin[hit] + (size[hit] - j) * unit] = True
    return [flags[b : b + max(0, n - width + 1)] for b, n in zip(begin, length)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def covered(size: int, runs, width: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the strings that start in the runs."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        start, end = start, min(end + width - 1, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def one_body_a_text(documents: DataFrame) -> DataFrame:
    """tid (md5) and compressed body of each different text; copies go before the shuffle."""

    def packed(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            bodies = pa.array([pack.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield batch.drop_columns(["text"]).append_column("body", bodies)

    body = F.coalesce("text", F.lit(""))
    bodies = documents.select(F.md5(body).alias("tid"), body.alias("text")).mapInArrow(packed, "tid string, body binary")
    return bodies.withColumn("tid", F.unhex("tid")).groupBy("tid").agg(F.first("body").alias("body"))


def drop_repeats(
    documents: DataFrame, width: int = 200, bucket_bytes: int = 4_000_000, batch_bytes: int = 60_000, crowd: int = 4096
) -> DataFrame:
    """All rows with their texts less every byte of a ``width``-byte string that occurs elsewhere.

    Columns: those of the input (text replaced), n_bytes, n_removed, n_spans and
    kept_bytes.  Texts are taken as UTF-8 bytes; null counts as empty (its text stays
    null); texts shorter than ``width`` lose nothing; matches never cross rows.
    Repeated rows repeat each other and lose everything.  A removal may cut through a
    character; the bytes left of it become U+FFFD in text, never in kept_bytes.
    Input columns of the added names are replaced.

    An anchor with more than ``crowd`` different pieces is no batch of one task: its strings
    are counted each by their 128-bit digest, with partial counts before the shuffle.
    """
    body = F.coalesce("text", F.lit(""))
    ids = documents.select(F.md5(body).alias("tid"), body.alias("text"))

    def pieces(batches):
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for low, high in slices(texts):
                text, start, strings, key, content, left, right = cut(texts[low:high], width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("tid").slice(low, high - low).take(pa.array(text)), pa.array(key.view(np.int64)),
                     pa.array(start), pa.array(strings.astype(np.int32)), pa.array(content.view(np.int64)),
                     pa.array(left.view(np.int64)), pa.array(right.view(np.int64))],
                    ["tid", "key", "start", "strings", "content", "left", "right"],
                )

    found = ids.mapInArrow(
        pieces, "tid string, key long, start long, strings int, content long, left long, right long"
    )
    found = written(found.withColumn("tid", F.unhex("tid")), "found")
    keys = (
        found.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
        .where("n > 1")
        .select("key", (F.col("low") != F.col("high")).alias("mixed"))
    )
    keys = written(keys, "keys")  # of its own, so that a join by a hot key can be split
    met = written(found.join(keys, "key"), "met")
    kinds = (
        met.where("mixed")
        .groupBy("key", "content", "strings")
        .agg(F.count("*").alias("n"), F.min(F.struct("tid", "start")).alias("one"),
             F.first("left").alias("left"), F.first("right").alias("right"))
    )
    kinds = written(kinds, "kinds")
    sides = kinds.select("key", "content", F.explode(F.array("left", "right")).alias("side")).where("side <> 0")
    alike = sides.groupBy("key", "side").agg(F.count("*").alias("n")).where("n > 1").select("key", "side")
    alike = sides.join(alike, ["key", "side"]).select("key", "content").distinct()
    open_kinds = written(kinds.join(alike, ["key", "content"]).select("key", "content", "strings", "one"), "open")
    crowds = open_kinds.groupBy("key").agg((F.count("*") > crowd).alias("crowded"))
    size = open_kinds.agg(F.coalesce(F.sum(F.col("strings") + width), F.lit(0))).first()[0]
    dense = bool(crowds.agg(F.max("crowded")).first()[0])
    wanted = (
        open_kinds.join(crowds, "key")
        .groupBy(F.col("one.tid").alias("tid"))
        .agg(F.collect_list(F.struct("one.start", "strings", "key", "content", "crowded")).alias("pieces"))
    )

    def fetch(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for body_, rows in zip(batch.column("body").to_pylist(), batch.column("pieces").to_pylist()):
                text, out = open_.decompress(body_), []
                for row in rows:
                    piece = text[row["start"] : row["start"] + row["strings"] + width - 1]
                    if row["crowded"]:
                        for i in range(row["strings"]):
                            digest = hashlib.md5(piece[i : i + width]).digest()
                            out.append((0, row["key"], row["content"], i, None, digest))
                    else:
                        out.append((row["key"] & (2**62 - 1), row["key"], row["content"], 0, piece, None))
                columns = list(zip(*out)) or [[]] * 6
                kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds_)], ["deal", "key", "content", "shift", "piece", "digest"]
                )

    bodies = one_body_a_text(documents)
    # Both sides grow with the documents: neither may be broadcast.
    fetched = bodies.join(wanted.hint("merge"), "tid").select("body", "pieces")
    dealt = fetched.mapInArrow(fetch, "deal long, key long, content long, shift long, piece binary, digest binary")
    if dense:
        dealt = written(dealt, "dealt")  # read as pieces, and as strings to count and to find again
    buckets = max(1, ceil(size / bucket_bytes))

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by("deal")
        rows, start = [], 0
        deal, piece = group["deal"].to_numpy(), group["piece"].to_pylist()
        marks = list(zip(*(group[c].to_pylist() for c in ("key", "content", "shift"))))
        size = np.cumsum([len(p) for p in piece])
        last = np.r_[np.flatnonzero(deal[1:] != deal[:-1]) + 1, len(deal)]
        while start < len(deal):
            # As many whole keys as fit a batch, one at least: at most ``crowd`` pieces.
            fit = np.searchsorted(size[last - 1], (size[start - 1] if start else 0) + batch_bytes, side="right")
            stop = int(max(last[max(fit - 1, 0)], last[np.searchsorted(last, start, side="right")]))
            distinct: dict[bytes, int] = {}
            own = {m: distinct.setdefault(p, len(distinct)) for m, p in zip(marks[start:stop], piece[start:stop])}
            shared = np.bincount(list(own.values()), minlength=len(distinct)) > 1
            flags = repeated(list(distinct), width)
            for (key, content, shift), i in own.items():
                for a, b in [(0, len(flags[i]))] if shared[i] else _runs(flags[i]) if flags[i].any() else ():
                    rows.append((key, content, shift + a, shift + b))
            start = stop
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["key", "content", "low", "high"])

    settled = dealt.where("digest is null").drop("digest").withColumn("bucket", F.pmod("deal", F.lit(buckets))).groupBy("bucket")
    settled = settled.applyInArrow(settle, "key long, content long, low long, high long")
    if dense:
        strings = dealt.where("digest is not null").select("digest", "key", "content", "shift")
        twice = strings.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
        found_ = strings.join(twice, "digest").select("key", "content", F.col("shift").alias("low"), (F.col("shift") + 1).alias("high"))
        settled = settled.unionByName(found_)
    runs = settled.groupBy("key", "content").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    copied = kinds.select("key", "content", F.col("n").alias("copies"))
    told = copied.join(runs, ["key", "content"], "left").where("copies > 1 or runs is not null")
    told = written(told, "told")  # as the keys
    contested = (
        met.where("mixed")
        .select("tid", "key", "start", "strings", "content")
        .join(told, ["key", "content"])
        .select("tid", F.explode(F.expr(
            "if(copies > 1, array(named_struct('low', start, 'high', start + strings)), "
            "transform(runs, r -> named_struct('low', start + r.low, 'high', start + r.high)))"
        )).alias("run"))
    )
    plain = met.where("not mixed").select(
        "tid", F.struct(F.col("start").alias("low"), (F.col("start") + F.col("strings")).alias("high")).alias("run")
    )
    marked = plain.unionByName(contested).groupBy("tid").agg(F.collect_set("run").alias("_runs"))

    added = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]
    rest = [c for c in documents.columns if c not in added and c != "text"]

    def strip(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            total, removed, spans, kept = [], [], [], []
            for body_, runs_ in zip(batch.column("_body").to_pylist(), batch.column("_runs").to_pylist()):
                text = open_.decompress(body_)
                cuts = covered(len(text), [(r["low"], r["high"]) for r in runs_ or ()], width)
                places = [0, *(x for pair in cuts for x in pair), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(places[0::2], places[1::2])))
                total.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append(len(cuts))
            out = batch.select(rest).append_column("n_bytes", pa.array(total, pa.int64()))
            out = out.append_column("n_removed", pa.array(removed, pa.int64()))
            out = out.append_column("n_spans", pa.array(spans, pa.int64()))
            out = out.append_column("kept_bytes", pa.array(kept, pa.binary()))
            texts = [None if null else k.decode(errors="replace") for null, k in zip(batch.column("_null").to_pylist(), kept)]
            yield out.append_column("text", pa.array(texts, pa.string()))

    def squeeze(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            bodies_ = pa.array([pack.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
            null = batch.column("text").is_null()
            yield batch.select([*rest, "_tid"]).append_column("_body", bodies_).append_column("_null", null)

    schema = documents.schema
    shape = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in rest)
    rows = documents.select(*rest, "text", F.md5(body).alias("_tid"))
    rows = rows.mapInArrow(squeeze, f"{shape}{', ' if shape else ''}_tid string, _body binary, _null boolean")
    joined = rows.withColumn("_tid", F.unhex("_tid")).join(
        marked.withColumnRenamed("tid", "_tid").hint("merge"), "_tid", "left"
    ).drop("_tid")
    result = joined.mapInArrow(
        strip, f"{shape}{', ' if shape else ''}n_bytes long, n_removed long, n_spans long, kept_bytes binary, text string"
    )
    return result.select(*(c for c in documents.columns if c not in added), *added)

