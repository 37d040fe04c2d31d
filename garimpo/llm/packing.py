"""Packing of token ids into windows of several lengths.

Documents are routed by their token count: whole windows of the longest length leave
at once, what is left of a document goes to the shortest tier that holds it.
Rests over half a window open a window each, and its gap is filled from the
stream of the shorter tiers, shortest first; what is left of every tier's stream is
cut into windows of that tier's length.  All places come from prefix sums, so no
task sees more than one part of the corpus.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Recent, kept, slices, written

#: Letters and numbers up to U+024F, where every library agrees on the classes.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
#: The word pattern of byte-level BPE files, a fixed value, for texts of such characters.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
OTHER = re.compile("[^\t\n\r -~¡-ɏ]")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file on this machine; a path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: The characters that byte-level files write for the bytes 0 to 255.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*SHOWN}))}


def word_encoder(made):
    """A function from words to lists of their ids.

    A file that does nothing but split at words and show bytes as characters has its model asked
    directly; otherwise the whole tokenizer is.  No word holds a zero.
    """

    def whole(words: list[str]) -> list[list[int]]:
        found = []
        for at in range(0, len(words), 10_000):
            found += [e.ids for e in made.encode_batch_fast(words[at : at + 10_000], add_special_tokens=False)]
        return found

    def direct(words: list[str]) -> list[list[int]]:
        shown = "\0".join(words).encode().decode("latin-1").translate(BYTES).split(BYTES[0])
        return [[t.id for t in tokens(w)] for w in shown] if words else []

    plain = json.loads(made.to_str())
    split = plain["pre_tokenizer"] or {}
    if plain["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        return whole
    tokens = made.model.tokenize
    return direct


def encode(texts: DataFrame, tokenizer: str, end: int | None = 1) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, two bytes an id if the vocabulary allows) of each text.

    The ids are those of the tokenizer file, named or by its path, which each executor finds for
    itself; a word met before is looked up.  ``end`` is appended to every document.  A null text
    counts as empty.  The file must be a byte-level BPE, whose merges never cross words; texts with its
    special tokens or unusual characters go to the tokenizer whole.
    """

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        held = kept(tokenizer)
        if not held:
            held["made"] = Tokenizer.from_file(tokenizer_file(tokenizer))
            held["words"], held["encode"] = Recent(2**26), word_encoder(held["made"])
        made, known, encoded = held["made"], held["words"], held["encode"]
        kind = np.dtype("<u2" if made.get_vocab_size() <= 2**16 else "<u4")
        code = "H" if kind.itemsize == 2 else "I"
        special = [t.content for t in made.get_added_tokens_decoder().values()]
        words = re.compile(WORDS)
        last = b"" if end is None else np.array([end], kind).tobytes()
        for batch in batches:
            out = []
            texts_ = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in slices(texts_, 200_000):
                odd = [OTHER.search(t) or any(s in t for s in special) for t in texts_[low:high]]
                split = [[] if o else words.findall(t) for o, t in zip(odd, texts_[low:high])]
                new = known.missing(chain.from_iterable(split))  # not met lately
                for word, found in zip(new, encoded(new)):
                    known.add(word, array(code, found).tobytes())
                for o, text, found in zip(odd, texts_[low:high], split):
                    if o:
                        ids = np.array(made.encode(text, add_special_tokens=False).ids, kind).tobytes()
                    else:
                        ids = b"".join(map(known.young.__getitem__, found))
                    out.append(ids + last)
            counts = pa.array([len(x) // kind.itemsize for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def pack(tokens: DataFrame, length: int = 2048, tiers: int = 4, step_tokens: int = 2**19) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset, window, step.

    ``tokens`` is what ``encode`` returns.  ``length`` is a power of two; the tiers
    are it and its halves.  Every id lies in exactly one piece; ids are 32-bit
    little-endian.  Every sequence is full: its ``window`` is ``length``, a tier's
    length, or for the last ids of each tier's stream a smaller power of two.  Documents
    without tokens have no piece; repeated rows are packed each.  Sequences of equal windows
    are dealt in turn over steps, so that steps hold equal numbers of tokens and mixes of
    windows.
    """
    tokens = written(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    sizes = [length >> (tiers - 1 - i) for i in range(tiers)]
    rest, full = F.col("n_tokens") % length, F.floor(F.col("n_tokens") / length)
    docs = tokens.where("n_tokens > 0").select(
        "row", "n_tokens", F.shiftright("row", 33).alias("part"), full.alias("full"), rest.alias("rest"),
    )
    lows = [0, *sizes[:-1]]
    inside = [(F.col("rest") > low) & (F.col("rest") <= high) for low, high in zip(lows, sizes)]
    docs = docs.withColumn("head", inside[-1].cast("long")).withColumn("gap", F.col("head") * (length - F.col("rest")))
    docs = docs.withColumn("opened", F.col("head") * F.col("rest"))
    for k in range(tiers - 1):
        docs = docs.withColumn(f"t{k}", F.when(inside[k], F.col("rest")).otherwise(0))
    sums = ["full", "head", "gap", "opened", *(f"t{k}" for k in range(tiers - 1))]
    parts = docs.groupBy("part").agg(*(F.sum(c).alias(f"part_{c}") for c in sums))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", *(F.coalesce(F.sum(f"part_{c}").over(ahead), F.lit(0)).alias(f"base_{c}") for c in sums))
    earlier = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.select("*", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"at_{c}") for c in sums)).join(bases, "part")
    for c in sums:
        placed = placed.withColumn(f"at_{c}", F.col(f"at_{c}") + F.col(f"base_{c}")).drop(f"base_{c}")
    placed = written(placed, "placed")
    total = parts.agg(*(F.coalesce(F.sum(f"part_{c}"), F.lit(0)).alias(c) for c in sums)).first()
    stream = sum(total[f"t{k}"] for k in range(tiers - 1))
    fits = (F.col("head") == 1) & (F.col("at_gap") + F.col("gap") <= stream)
    used = placed.where(fits).agg(
        F.coalesce(F.max(F.col("at_gap") + F.col("gap")), F.lit(0)), F.coalesce(F.sum("rest"), F.lit(0)), F.count("*")
    ).first()
    filled, opened, heads = used

    whole = placed.where("full > 0").select(
        "row", F.explode(F.expr("sequence(0L, full - 1)")).alias("k"), "at_full"
    ).select(
        "row", (F.col("k") * length).alias("start"), F.lit(length).cast("long").alias("length"),
        (F.col("at_full") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(length).cast("long").alias("window"),
    )
    tail = (F.col("full") * length).alias("start")
    first = placed.where(fits).select(
        "row", tail, F.col("rest").alias("length"), (F.col("at_head") + total["full"]).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(length).cast("long").alias("window"),
    )

    # One line of ids: the tiers' streams, then the heads that no gap filler was left for.
    begin = [sum(total[f"t{j}"] for j in range(k)) for k in range(tiers)]
    at = F.when(F.col("head") == 1, stream + F.col("at_opened") - opened)
    for k in range(tiers - 1):
        at = at.when(F.col(f"t{k}") > 0, F.col(f"at_t{k}") + begin[k])
    line = placed.where((F.col("rest") > 0) & ~fits).select("row", tail, at.alias("low"), (at + F.col("rest")).alias("high"))
    spark = tokens.sparkSession
    slot = "low long, high long, sequence_id long, offset long, window long"
    gaps = placed.where(fits & (F.col("gap") > 0)).select(
        F.col("at_gap").alias("low"), (F.col("at_gap") + F.col("gap")).alias("high"),
        (F.col("at_head") + total["full"]).alias("sequence_id"), F.col("rest").alias("offset"),
        F.lit(length).cast("long").alias("window"),
    )
    slots, number, last = gaps, total["full"] + heads, []
    ends = [*begin[1:], stream + total["opened"] - opened]
    for k, size in enumerate(sizes):
        low, high = max(begin[k], filled), ends[k]
        count = max(0, high - low) // size
        slots = slots.unionByName(
            spark.range(count).select(
                (F.col("id") * size + low).alias("low"), (F.col("id") * size + low + size).alias("high"),
                (F.col("id") + number).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                F.lit(size).cast("long").alias("window"),
            )
        )
        number, low = number + count, low + count * size
        while low < high:
            size_ = 1 << ((high - low).bit_length() - 1)
            last.append((low, low + size_, number, 0, size_))
            low, number = low + size_, number + 1
    slots = slots.unionByName(spark.createDataFrame(last, slot))

    def touched(df: DataFrame) -> DataFrame:
        cells = F.sequence(F.floor(F.col("low") / length), F.floor((F.col("high") - 1) / length))
        return df.withColumn("cell", F.explode(cells))

    a, b = touched(line).alias("a"), touched(slots).alias("b")
    low = F.greatest("a.low", "b.low")
    met = a.join(b, "cell").where((low < F.least("a.high", "b.high")) & (F.floor(low / length) == F.col("cell")))
    streamed = met.select(
        "row", (F.col("start") + low - F.col("a.low")).alias("start"), (F.least("a.high", "b.high") - low).alias("length"),
        "sequence_id", (F.col("offset") + low - F.col("b.low")).alias("offset"), "window",
    )
    steps = max(1, sum(sizes[-1] * c for c in (total["full"], heads)) // step_tokens)
    pieces = whole.unionByName(first).unionByName(streamed)
    by_row = pieces.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset", "window"))).alias("pieces")
    )

    def pick(batches):
        for batch in batches:
            rows, ids = [], []
            for i, (n, body, cuts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_tokens", "ids", "pieces")))):
                held = np.frombuffer(body, "<u2" if len(body) == 2 * n else "<u4").astype("<u4")
                for c in cuts:
                    rows.append((i, c["start"], c["length"], n, c["sequence_id"], c["offset"], c["window"]))
                    ids.append(held[c["start"] : c["start"] + c["length"]].tobytes())
            i, start, size, n, sequence, offset, window = (pa.array(x, pa.int64()) for x in list(zip(*rows)) or [[]] * 7)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(i), start, size, pa.array(ids, pa.binary()), n, sequence, offset, window],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window"],
            )

    # Both sides grow with the documents: neither may be broadcast.
    picked = tokens.join(by_row.hint("merge"), "row").select("doc_id", "n_tokens", "ids", "pieces").mapInArrow(
        pick,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window long",
    )
    return picked.withColumn("step", F.col("sequence_id") % steps)
