"""Helpers of several operators: written tables, components of links, vectors, word hashes."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder


def released() -> None:
    """Give what this process has freed back to the system, where the C library can do so.

    After large arrays were freed it keeps much of them for later ones: 75 MB after a toxicity model.
    """
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, TypeError):  # glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there."""
    released()  # the driver of a pipeline shares its memory with what comes next
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of undirected links (a, b) of longs.

    Alternates two star steps until all edges are stars around their least nodes: larger neighbours
    move to the least node a node knows, then a node's smaller neighbours do.  The number of
    rounds grows with the logarithm of the nodes; links that are such stars take none.  Nodes without a link to
    another node get no row.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        larger = written(larger.where("a <> b").distinct(), "links")
        least = larger.groupBy("a").agg(F.min("b").alias("low"))
        smaller = larger.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        joined = smaller.unionByName(least.select("a", F.col("low").alias("b"))).where("a <> b")
        edges = written(joined.distinct(), "links")
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.unionByName(named.select(F.col("component").alias("node"), "component").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether distinct edges (a > b) lead from each a to one b only, which leads nowhere itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("end"))
    ups = ends.select("end.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.where("ups > 1 or ups = 1 and least = 0").isEmpty()


def united(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Least index of each index's component under the pairs (a, b)."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def kept(name: str) -> dict:
    """A dictionary that a worker process keeps for the tasks of one name; the last name's is dropped."""
    held = sys.__dict__.setdefault("_kept_words", {})
    if name not in held:
        held.clear()
        pa.default_memory_pool().release_unused()
    return held.setdefault(name, {})


class Recent:
    """Bytes of words met lately, in two generations of bounded size.

    ``young`` has all words asked for since the last change; when it is full it becomes the
    old one, whose words move back when they are met again.  So frequent words stay, and what
    is kept takes twice ``limit`` bytes at most, but for the words of one call.
    """

    def __init__(self, limit: int = 2**25, each: int = 200):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit, self.each, self.size = limit, each, 0

    def missing(self, words: Iterable[str]) -> list[str]:
        """Different words that are in neither generation; the others are young now."""
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        new = []
        for word in set(words).difference(self.young):
            value = self.old.get(word)
            if value is None:
                new.append(word)
            else:
                self.add(word, value)
        return new

    def add(self, word: str, value: bytes) -> None:
        self.young[word] = value
        self.size += len(word) + len(value) + self.each


def usable(column: str) -> str:
    """SQL condition: a vector without null or non-finite components."""
    return f"{column} is not null and forall({column}, x -> x is not null and abs(x) < double('infinity'))"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones padded by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


ODD = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Each 64-bit value through a well-spread bijection."""
    x = values + np.uint64((seed * ODD + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the longest so far is kept."""
    known = POWERS.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, dtype=np.uint64)
        while len(known) < n:
            known = np.concatenate((known, known * np.uint64(pow(base, len(known), 2**64))))
        POWERS[base] = known
    return known[:n]


#: ASCII white space ends a word.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


class Words:
    """Words of several texts, separated by the bytes of ``breaks`` and hashed without a loop.

    ``start`` and ``end`` are byte places in ``data`` (all texts joined, each
    followed by one space), ``text`` the text a word belongs to, ``hash`` its
    64-bit hash.
    """

    def __init__(self, texts: list[bytes], breaks: np.ndarray = SPACE):
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        self.data = data
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        blank = np.concatenate(([True], breaks[data]))
        turn = np.flatnonzero(blank[1:] != blank[:-1])
        self.start, self.end = turn[0::2], turn[1::2]
        self.text = np.searchsorted(ends, self.start, side="right")
        self.first = ends - np.array([len(t) + 1 for t in texts], dtype=np.int64) if texts else ends
        self.hash = mixed(self.sums(data.astype(np.uint64) + np.uint64(1)))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Polynomial hash of each word over per-byte values."""
        base = 0xD1342543DE82EF95
        n = len(values)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(base, n), dtype=np.uint64)))
        back = powers(pow(base, -1, 2**64), n + 1)
        return (total[self.end] - total[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64)


def slices(texts: list[bytes] | list[str], limit: int = 500_000):
    """Ranges of texts that hold about ``limit`` bytes (or characters) together; a longer text is alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def bodies(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 places where its texts begin; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def cuts(offsets: np.ndarray, limit: int):
    """Ranges of texts with about ``limit`` bytes together; a longer text is alone."""
    start = 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        yield start, max(end, start + 1)
        start = max(end, start + 1)


def shingles(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each text's distinct word shingles, in that order.

    A text of fewer words has one shingle, all its words; without words it has none.
    """
    found = Words(texts)
    n, h, owner = len(found.hash), found.hash, found.text
    step = 0xA24BAED4963EE407
    grams, whose = [], []
    if n >= words:
        total = np.zeros(n - words + 1, dtype=np.uint64)
        for k in range(words):
            total += h[k : n - words + 1 + k] * np.uint64(pow(step, k, 2**64))
        whole = owner[: n - words + 1] == owner[words - 1 :]
        grams.append(total[whole])
        whose.append(owner[: n - words + 1][whole])
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < words))
    total = np.zeros(len(short), dtype=np.uint64)
    for k in range(words - 1):
        here = count[short] > k
        total[here] += h[first[short[here]] + k] * np.uint64(pow(step, k, 2**64))
    g = mixed(np.concatenate([*grams, total]))
    owner = np.concatenate([*whose, short])
    order = np.lexsort((g, owner))
    g, owner = g[order], owner[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], g[new]
