"""Near copies of texts: a chosen-path join on word shingles.

Every repetition sends a text down the tree by a few of its shingles, drawn by a
hash that all texts share: similar texts draw the same ones.  A path held by
``bucket`` texts at most is compared by brute force on sketches.  A larger one is settled where
almost all of its texts are like a few of them, else split by another draw.  Sketch links only say which texts must be compared exactly; each
resulting cell is compared in full, in tiles of bounded size.
"""

from __future__ import annotations

from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, mixed, shingles, slices, united, written

BINS = 256


def _alike(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Sketch pairs that may reach the threshold: four standard errors of slack."""
    a, b = left[:, None, :], right[None, :, :]
    same = np.count_nonzero((a == b) & (a != 0), axis=2)
    filled = np.maximum(np.count_nonzero(a | b, axis=2), 1)
    slack = 4 * np.sqrt(threshold * (1 - threshold) / filled)
    return same >= (threshold - slack) * filled


def _like_heads(group: dict, threshold: float) -> list[int]:
    """Per row a number whose bit k is set if the row may be near one of the heads named k.

    A row's ``heads`` are (class, size, sketch) of some texts of its path; heads that may be near
    each other have one name, the first of them.
    """
    out, known = [], {}
    for path, size, sketch, heads in zip(group["path"], group["size"], group["sketch"], group["heads"]):
        if path not in known:
            known.clear()  # rows come path by path
            theirs = np.frombuffer(b"".join(h["sketch"] for h in heads), np.uint8).reshape(-1, BINS)
            sizes = np.array([h["size"] for h in heads])
            near = _alike(theirs, theirs, threshold) & _fits(sizes[:, None], sizes, threshold)
            known[path] = theirs, sizes, united(len(sizes), *np.nonzero(near))
        theirs, sizes, name = known[path]
        row = np.frombuffer(sketch, np.uint8)[None, :]
        near = _alike(row, theirs, threshold)[0] & _fits(np.int64(size), sizes, threshold)
        out.append(int(np.bitwise_or.reduce(1 << name[near], initial=0)))
    return out


def _fits(left, right, threshold: float):
    """Sizes of sets that may reach the threshold."""
    return np.minimum(left, right) >= threshold * np.maximum(left, right) * (1 - 1e-9)


def _sketch_links(sketch: np.ndarray, size: np.ndarray, one: np.ndarray, threshold: float) -> np.ndarray:
    """Least index of each row's component; pairs of two rows of which ``one`` marks one or both.

    ``one`` is None for all pairs within a block.
    """
    order = np.argsort(size, kind="stable")
    sketch, size = sketch[order], size[order]
    side = None if one is None else one[order]
    label = np.arange(len(size))
    for at in range(0, len(size), 32):
        rows = np.arange(at, min(at + 32, len(size)))
        last = np.searchsorted(size, size[rows[-1]] / threshold * (1 + 1e-9), side="right")
        a, b = np.nonzero(_alike(sketch[rows], sketch[at:last], threshold))
        a, b = rows[a], b + at
        pair = (a < b) & (size[a] >= threshold * size[b] * (1 - 1e-9))
        if side is not None:
            pair &= side[a] != side[b]
        label = united(len(size), a[pair], b[pair], label)
    out = np.empty_like(label)
    out[order] = order[label]
    return out


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    a, b = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (left, right))
    both = np.intersect1d(a, b)
    if not len(both):
        return out
    places = []
    for values, sets in ((a, left), (b, right)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[at] == values
        places.append((owner[hit], at[hit]))
    width = 4096
    for low in range(0, len(both), width):
        dense = []
        for (owner, at), sets in zip(places, (left, right)):
            here = (at >= low) & (at < low + width)
            m = np.zeros((len(sets), min(width, len(both) - low)), dtype=np.float32)
            m[owner[here], at[here] - low] = 1
            dense.append(m)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def runs_needed(recall: float, threshold: float, draws: float, deep_draws: float, levels: int) -> int:
    """Repetitions after which a pair at the threshold, all of whose common paths are crowded, is found.

    The common paths of a pair branch: each has Poisson many children, and the pair is
    missed if none is left on the last level.
    """
    miss = 0.0
    for level in range(levels):
        rate = draws if level == levels - 1 else deep_draws
        miss = exp(-threshold * rate * (1 - miss))
    return max(1, ceil(log(1 - recall) / log(miss)))


def near_documents(
    documents: DataFrame, threshold: float = 0.8, words: int = 5, repetitions: int | None = None, draws: float = 4.0,
    deep_draws: float | None = None, levels: int = 3, bucket: int = 1024, tile: int = 512, sample: int = 48,
    target_recall: float = 0.9999, heads: int = 4,
) -> DataFrame:
    """Links of Jaccard similarity >= threshold between texts, and their groups.

    One row per input row: doc_id, digest (md5 of the text), n_links, class_id,
    component_id, kept.  A text is the set of its distinct shingles of ``words``
    lower-case, white-space separated words; texts of equal sets are one class
    (class_id: its least doc_id), linked and counted each in n_links.  component_id
    is the least doc_id of the group; the row that holds it is kept, only one if rows are
    repeated.  Null, empty and blank texts have no shingle, no link, and are
    kept.  A null doc_id sorts last.  Other columns are ignored.

    A pair at the threshold draws a common shingle in one repetition with
    probability 1 - exp(-threshold * draws) at least.  Splitting a crowded path draws
    ``deep_draws`` shingles a text (``draws`` by default), by a hash of the path, from about
    ``sample`` shingles that similar texts share; the draws of different paths are independent.
    Without ``repetitions`` there are as many as a pair at the threshold needs to be found with
    ``target_recall`` even if all its common paths are crowded on every level.  What is found is
    compared exactly.

    A crowded path is not split but settled if all of its texts but ``bucket`` at most may be near one
    of a few of them (``heads``): these are tied together, and the others are compared with all texts
    of the path.  So no pair that meets in a settled path is lost, and a group of copies does not
    descend.
    """
    deep_draws = draws if deep_draws is None else deep_draws
    if repetitions is None:
        repetitions = runs_needed(target_recall, threshold, draws, deep_draws, levels)

    def sign(batches):
        for batch in batches:
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            for low, high in slices(texts):
                n = high - low
                owner, g = shingles(texts[low:high], words)
                size = np.bincount(owner, minlength=n)
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
                ids = np.zeros((2, n), dtype=np.uint64)
                if len(owner):
                    ids[0, owner[starts]] = np.add.reduceat(mixed(g, 1), starts)
                    ids[1, owner[starts]] = np.bitwise_xor.reduceat(mixed(g, 2), starts)
                sketch = np.zeros((n, BINS), dtype=np.uint8)
                cell = owner * BINS + (g >> np.uint64(56)).astype(np.int64)
                head = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else cell
                sketch.reshape(-1)[cell[head]] = (mixed(g[head], 3) % np.uint64(255)).astype(np.uint8) + 1
                chosen = []
                for k in range(repetitions + 1):
                    rate = np.minimum(1.0, (draws if k < repetitions else sample) / np.maximum(size, 1))
                    mark = mixed(g, 10 + k)
                    hit = (mark >> np.uint64(11)) < (rate * 2.0**53).astype(np.uint64)[owner]
                    offsets = np.r_[0, np.cumsum(np.bincount(owner[hit], minlength=n))].astype(np.int32)
                    chosen.append(pa.ListArray.from_arrays(offsets, pa.array(mark[hit].view(np.int64))))
                rows = batch.slice(low, n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("digest"), pa.array(ids[0].view(np.int64)),
                     pa.array(ids[1].view(np.int64)), pa.array(size.astype(np.int32)),
                     pa.array([row.tobytes() for row in sketch], pa.binary()), *chosen],
                    ["doc_id", "digest", "set_a", "set_b", "size", "sketch",
                     *names],
                )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), "text")
    names = [*(f"draw{k}" for k in range(repetitions)), "deep"]
    draws_ = ", ".join(f"{name} array<long>" for name in names)
    signed = texts.mapInArrow(
        sign, f"doc_id long, digest string, set_a long, set_b long, size int, sketch binary, {draws_}"
    )
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "digest")
    classes = (
        signed.where("size > 0")
        .groupBy("set_a", "set_b")
        .agg(F.min(place).alias("head"), F.count("*").alias("copies"),
             *(F.first(c).alias(c) for c in ("size", "sketch", *names)))
        .withColumn("class", F.monotonically_increasing_id())
    )
    classes = written(classes, "classes")

    marked = classes.select("class", F.posexplode(F.array(*names[:-1])).alias("run", "marks"))
    paths = marked.select("class", F.explode(F.transform("marks", lambda m: F.xxhash64("run", m))).alias("path"))
    paths = written(paths, "paths")
    # Texts of unequal sizes draw alike: a shingle is drawn by both at the rate of the larger one.
    chance = F.lit(deep_draws) / F.least(F.col("size"), F.lit(sample)) * 2**30
    sketches = classes.select("class", "size", "sketch")

    def like_heads(batches):
        for batch in batches:
            for at in range(0, len(batch), 4096):
                rows = batch.slice(at, 4096)
                bits = _like_heads(rows.select(["path", "size", "sketch", "heads"]).to_pydict(), threshold)
                yield rows.select(["path", "class", "n"]).append_column("bits", pa.array(bits, pa.int32()))

    def settle(crowded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Of (path, class, n): ties (a, b), tiles of other texts with all of their path, and rows to split."""
        drawn = [F.min(F.struct(F.xxhash64("path", "class", F.lit(k)).alias("h"), "class"))["class"] for k in range(heads)]
        chosen = crowded.groupBy("path").agg(F.array(*drawn).alias("ids"))
        chosen = written(
            chosen.select("path", F.explode("ids").alias("class"))
            .join(sketches, "class")
            .groupBy("path")
            .agg(F.sort_array(F.collect_list(F.struct("class", "size", "sketch"))).alias("heads")),
            "heads",
        )
        held = crowded.join(sketches, "class").join(chosen, "path")
        held = held.select("path", "class", "n", "size", "sketch", "heads")
        seen = written(held.mapInArrow(like_heads, "path long, class long, n long, bits int"), "seen")
        named = [F.struct(F.sum(F.bit_get("bits", F.lit(k)).cast("long")).alias("like"), F.lit(k).alias("name"))
                 for k in range(heads)]
        best = seen.groupBy("path").agg(F.greatest(*named).alias("best"), F.count("*").alias("all"))
        best = written(
            best.join(chosen.select("path", F.transform("heads", lambda h: h["class"]).alias("ids")), "path").select(
                "path", F.col("best.name").alias("name"), (F.col("all") - F.col("best.like")).alias("others"),
                F.expr("ids[best.name]").alias("head"),
            ),
            "best",
        )
        told = seen.join(best, "path").withColumn("like", F.expr("bit_get(bits, name) = 1"))
        done = F.col("others") <= bucket
        ties = told.where(done & F.col("like")).select(F.col("class").alias("a"), F.col("head").alias("b"))
        partly = told.where(done & (F.col("others") > 0)).withColumn("blocks", F.ceil(F.col("n") / bucket).cast("int"))
        block = F.expr("cast(pmod(xxhash64(class), blocks) as int)").alias("block")
        own = partly.select("path", "class", block, F.lit(False).alias("other"))
        sent = partly.where(~F.col("like")).select(
            "path", "class", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(True).alias("other")
        )
        return ties, own.unionByName(sent), told.where(~done).select("path", "class", "n")

    def other_tile(group: pa.Table) -> pa.Table:
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        other = group["other"].to_numpy()
        label = _sketch_links(sketch, group["size"].to_numpy(), other, threshold)
        ids = group["class"].to_numpy()
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": ids[tied], "b": ids[label[tied]]})

    leaves, likely = None, None
    for level in range(levels):
        counts = paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        sized = paths.join(counts, "path")
        sized = written(sized.select("path", "class", "n"), "sized")
        done = sized.where(F.col("n") <= bucket)
        leaves = done if leaves is None else leaves.unionByName(done)
        crowded = sized.where(F.col("n") > bucket)
        if not crowded.head(1):
            break
        ties, others, crowded = settle(crowded)
        others = others.join(sketches, "class").groupBy("path", "block").applyInArrow(other_tile, "a long, b long")
        ties = ties.unionByName(others)
        likely = ties if likely is None else likely.unionByName(ties)
        if level == levels - 1:
            leaves = leaves.unionByName(crowded)
        else:
            crowded = crowded.select("path", "class").join(classes.select("class", "size", "deep"), "class")
            drawn = F.filter("deep", lambda m: F.pmod(F.xxhash64("path", m), F.lit(2**30)) < chance)
            children = F.transform(drawn, lambda m: F.xxhash64("path", m, F.lit(level)))
            paths = written(crowded.select("class", F.explode(children).alias("path")), "paths")

    def tiles(rows: DataFrame, side: int) -> DataFrame:
        return (
            rows.withColumn("blocks", F.ceil(F.col("n") / side).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
            .withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
            .withColumn("i", F.least("block", "with"))
            .withColumn("j", F.greatest("block", "with"))
            .drop("blocks", "with")
        )

    def sketch_tile(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        one = None if i == j else group["block"].to_numpy() == i
        label = _sketch_links(sketch, group["size"].to_numpy(), one, threshold)
        ids = group["class"].to_numpy()
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": ids[tied], "b": ids[label[tied]]})

    # Sketches are small: a bucket is one tile, and only what no level has split has several.
    met = tiles(leaves.join(sketches, "class"), bucket)
    compared = met.groupBy("path", "i", "j").applyInArrow(sketch_tile, "a long, b long")
    likely = compared if likely is None else likely.unionByName(compared)
    cells = components(likely)
    cells = cells.join(cells.groupBy("component").agg(F.count("*").alias("n")), "component")
    members = written(
        cells.withColumnRenamed("node", "class")
        .join(classes.select("class", "copies", "head.doc_id", "head.digest"), "class"),
        "members",
    )

    def sets(batches):
        for batch in batches:
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            for low, high in slices(texts):
                owner, g = shingles(texts[low:high], words)
                cut = np.searchsorted(owner, np.arange(high - low + 1))
                rows = [g[cut[i] : cut[i + 1]].tobytes() for i in range(high - low)]
                out = batch.slice(low, high - low).drop_columns(["text"])
                yield out.append_column("grams", pa.array(rows, pa.binary()))

    # Both sides grow with the documents: neither may be broadcast.
    held = members.hint("merge").alias("m").join(
        texts.alias("t"), F.expr("m.digest = t.digest and m.doc_id <=> t.doc_id")
    ).select("m.component", "m.n", "m.class", "m.copies", "t.text")
    held = held.mapInArrow(sets, "component long, n long, class long, copies long, grams binary")

    def exact_tile(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        ids, first = np.unique(group["class"].to_numpy(), return_index=True)  # repeated rows come once
        group = group.take(first)
        grams = [np.frombuffer(g, np.uint64) for g in group["grams"].to_pylist()]
        size, copies = np.array([len(g) for g in grams]), group["copies"].to_numpy()
        block = group["block"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        common = _shared_counts([grams[k] for k in left], [grams[k] for k in right])
        near = common / np.maximum(size[left][:, None] + size[right] - common, 1) >= threshold
        a, b = np.nonzero(near)
        a, b = left[a], right[b]
        a, b = a[a != b], b[a != b]
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, a, copies[b])
        if i != j:
            np.add.at(links, b, copies[a])
        label = united(len(ids), a, b)
        return pa.table({"a": ids, "b": ids[label], "links": links})

    compared = tiles(held, tile).groupBy("component", "i", "j")
    compared = written(compared.applyInArrow(exact_tile, "a long, b long, links long"), "compared")
    counted = compared.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "class")
    groups = components(compared.select("a", "b")).withColumnRenamed("node", "class")
    named = (
        classes.select("set_a", "set_b", "class", "copies", "head")
        .join(counted, "class", "left")
        .join(groups, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    heads = named.groupBy("component").agg(F.min("head").alias("first"))
    result = named.join(heads, "component").select(
        "set_a", "set_b", "first", F.col("head.doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = signed.select("doc_id", "digest", "row", "set_a", "set_b", "size")
    linked = rows.where("size > 0").join(result, ["set_a", "set_b"]).select(
        "doc_id", "digest", "n_links", "class_id", F.col("first.doc_id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    alone = rows.where("size = 0").select(
        "doc_id", "digest", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return linked.unionByName(alone)


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` that ``near_documents`` keeps, with all their columns."""
    kept = near_documents(documents, **options).where("kept").groupBy("doc_id", "digest").agg(F.count("*").alias("times"))
    kept = kept.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), F.col("times").alias("_times"))
    rows = documents.withColumn("_text", F.md5("text"))
    joined = rows.join(kept, F.expr("_text <=> _digest and doc_id <=> _doc"))
    turn = F.row_number().over(Window.partitionBy("_doc", "_digest").orderBy(F.lit(1)))
    return joined.withColumn("_turn", turn).where("_turn <= _times").select(*documents.columns)
