"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled texts gives the examples, with all their words; document
frequencies for the weights come from all texts, also those of words that no example has, which
count for the length of a document's vector.  Words whose document frequency differs between the
labels, to either side, weigh more; none is dropped.  Examples lie in blocks: words of few examples are
summed from their lists, common ones have their largest weight in each block, and blocks are read in
the order of their bound until no bound beats the k-th best similarity.
"""

from __future__ import annotations

import hashlib
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, bodies, kept, released, slices, written

#: Everything in ASCII but letters and digits ends a term.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[:128] = True
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of all words of lower-case texts."""
    found = Words(texts, BREAKS)
    return found.text, found.hash


def _counts(texts: list[bytes], terms: np.ndarray):
    """(text, place in sorted ``terms``, times) of the terms that occur, and (text, term, times) of the other words."""
    text, term = _terms(texts)
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    start = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (term[1:] != term[:-1])][: len(text)])
    times = np.diff(np.r_[start, len(text)])
    text, term = text[start], term[start]
    if not len(terms):
        return (np.empty(0, np.int64),) * 3, (text, term, times)
    place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
    hit = terms[place] == term
    return (text[hit], place[hit], times[hit]), (text[~hit], term[~hit], times[~hit])


class Index:
    """Block-max index of unit vectors (rows of terms and weights).

    Terms of more than a quarter of the rows are dense in each block, the others are lists.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, width: int = 64):
        self.width, self.size = width, len(rows)
        self.blocks = max(1, -(-len(rows) // width))
        # Lists are read at random places: the fewer bytes, the more of them stay in the processor's cache.
        numbers = np.arange(len(rows), dtype=np.min_scalar_type(self.blocks * width))
        owner = np.repeat(numbers, [len(t) for t, _ in rows])
        term = np.concatenate([t for t, _ in rows] or [np.empty(0, np.int64)])
        weight = np.concatenate([w for _, w in rows] or [np.empty(0)])
        common = np.bincount(term, minlength=n_terms) * 4 > len(rows)
        self.dense_at = np.where(common, np.cumsum(common) - 1, -1)
        self.dense = np.zeros((int(common.sum()), self.blocks * width))
        here = common[term]
        self.dense[self.dense_at[term[here]], owner[here]] = weight[here]
        self.most = self.dense.reshape(-1, self.blocks, width).max(axis=2).T
        del here
        order = np.argsort(term, kind="stable")  # rows of a term stay in their order
        order = order[~common[term[order]]]
        self.owner, self.weight = owner[order], weight[order]
        del owner, weight
        listed = np.where(common, 0, np.bincount(term, minlength=n_terms))
        self.at = np.concatenate((np.zeros(1, np.int64), np.cumsum(listed)))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The k rows of highest positive similarity, ties to the earlier row."""
        at = self.dense_at[terms]
        full = np.zeros(len(self.dense))
        full[at[at >= 0]] = weights[at >= 0]
        rare, own = terms[at < 0], weights[at < 0]
        low, n = self.at[rare], self.at[rare + 1] - self.at[rare]
        lists = list(map(slice, low.tolist(), (low + n).tolist())) or [slice(0, 0)]
        pull = np.concatenate([self.weight[s] for s in lists])
        pull *= np.repeat(own, n)
        part = np.bincount(np.concatenate([self.owner[s] for s in lists]), pull, self.blocks * self.width)
        part = part.reshape(self.blocks, self.width)
        bound = part.max(axis=1) + self.most @ full
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound > 0)]
        best, values = np.empty(0, np.int64), np.empty(0)
        at, step = 0, 4  # the first blocks give the bound for all others
        while at < len(order):
            least = values[-1] - 1e-12 if len(best) == k else 0.0
            some = order[at : at + step]
            some = some[: np.count_nonzero(bound[some] >= least)]
            if not len(some):
                break
            if 4 * len(some) > self.blocks:  # one product over all blocks is cheaper than a copy of these
                scores = part[some] + (full @ self.dense).reshape(part.shape)[some]
            else:
                scores = part[some] + np.stack([full @ self.dense[:, b * self.width : (b + 1) * self.width] for b in some])
            if skip >= 0:
                scores[some == skip // self.width, skip % self.width] = 0
            block, column = np.nonzero((scores > 0) & (scores >= least))
            rows = np.concatenate((best, some[block] * self.width + column))
            found = np.concatenate((values, np.round(scores[block, column], 12)))
            first = np.lexsort((rows, -found))[:k]
            best, values = rows[first], found[first]
            at, step = at + step, len(order)
        return list(zip(values.tolist(), best.tolist()))


class Model:
    """Terms, weights, examples and calibration; ``search`` gives a text's votes before its length is known."""

    #: Votes that a worker keeps for texts met before, some 400 bytes each.
    most_known = 2**15

    def __init__(self, terms, idf, ids, toxic, weight, vectors, k):
        self.terms, self.idf, self.ids, self.toxic, self.weight, self.k = terms, idf, ids, toxic, weight, k
        held = [i for i, (t, _) in enumerate(vectors) if len(t)]
        self.held = np.array(held, dtype=np.int64)
        self.index = Index([vectors[i] for i in held], len(terms))
        total = weight.sum()
        self.prior = float((weight * toxic).sum() / total) if total else 0.5
        bare = np.array([not len(t) for t, _ in vectors], dtype=bool)
        self.bare = float(((weight * toxic)[bare].sum() + self.prior) / (weight[bare].sum() + 1)) if len(bare) else 0.5
        self.a, self.b = 1.0, 0.0
        found = [self.vote(*vectors[i], skip=j) for j, i in enumerate(held)]
        votes = np.array([(toxic_ + self.prior) / (pull + 1) for pull, toxic_, _ in found])
        if len(votes):
            self.a, self.b = _platt(_logit(votes), toxic[self.held], weight[self.held])
        self.known: dict[bytes, tuple] = {}
        self.outer: DataFrame | None = None

    def vote(self, terms, weights, skip=-1) -> tuple[float, float, list[int]]:
        """Weighted similarity to all near examples and to the toxic ones, and the nearest."""
        near = self.index.nearest(terms, weights, self.k, skip)
        rows = self.held[[r for _, r in near]] if near else np.empty(0, np.int64)
        pull = np.array([s for s, _ in near]) * self.weight[rows]
        return float(pull.sum()), float((pull * self.toxic[rows]).sum()), [int(self.ids[r]) for r in rows[:3]]

    def search(self, terms: np.ndarray, times: np.ndarray) -> tuple[float, float, float, list[int]]:
        """Square of the length over the known terms, then the vote of the unit vector of these."""
        if not len(terms):
            return 0.0, 0.0, 0.0, []
        key = hashlib.blake2b(terms.tobytes(), digest_size=16)
        key.update(times.tobytes())
        key = key.digest()
        if key not in self.known:
            if len(self.known) >= self.most_known:
                self.known.clear()
            w = (1 + np.log(times)) * self.idf[terms]
            square = float((w * w).sum())
            self.known[key] = (square, *self.vote(terms, w / np.sqrt(square)))
        return self.known[key]

    def state(self) -> tuple[dict, dict]:
        """Plain values, for a broadcast that workers read once."""
        held = {n: getattr(self, n) for n in ("terms", "idf", "ids", "toxic", "weight", "k", "held")}
        return held, vars(self.index)


def _revived(name: str, state: tuple[dict, dict]) -> Model:
    models = kept("toxicity")
    if name not in models:
        models.clear()
        model, model.index = Model.__new__(Model), Index.__new__(Index)
        vars(model).update(state[0], known={})
        vars(model.index).update(state[1])
        models[name] = model
    return models[name]


def _flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that rows hold as bytes, all joined, and the n + 1 places where rows begin; nothing is copied."""
    if not len(column):
        return np.empty(0, kind), np.zeros(1, np.int64)
    data, offsets = bodies(column.combine_chunks())
    return data.view(kind), offsets // np.dtype(kind).itemsize


def unit(times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(times)) * idf
    return w / np.sqrt((w * w).sum())


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _platt(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit, by Newton's steps with a small ridge."""
    rows, beta = np.column_stack((x, np.ones_like(x))), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (w * (p - y)) + 0.1 * (beta - [1.0, 0.0])
        curve = (rows * (w * p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        beta = beta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit(documents: DataFrame, labels: DataFrame, per_class: int = 4000, k: int = 15) -> Model:
    """Model from at most ``per_class`` labelled texts of each label and the counts of all texts.

    ``labels`` has doc_id and toxic (0, 1; others are skipped; a document labelled
    both is toxic).  Examples are drawn by a hash; each counts for its share of the labelled
    rows.  Without labels every score is 0.5.
    """
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = None
    for value in (0, 1):
        part = marked.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)

    def vectors(batches):
        for batch in batches:
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            for low, high in slices(texts):
                _, (text, term, times) = _counts(texts[low:high], np.empty(0, np.uint64))
                cut = np.searchsorted(text, np.arange(high - low + 1))
                times = times.astype(np.int32)
                out = batch.slice(low, high - low).select(["doc_id", "toxic"])
                for name, values in (("terms", term), ("times", times)):
                    held = [values[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                    out = out.append_column(name, pa.array(held, pa.binary()))
                yield out

    # The sample has at most 2 * per_class rows.
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    chosen = chosen.select("doc_id", "toxic", "text").mapInArrow(vectors, "doc_id long, toxic int, terms binary, times binary")
    chosen = chosen.toArrow().sort_by("doc_id")
    ids, toxic = chosen["doc_id"].to_numpy().copy(), chosen["toxic"].to_numpy().astype(np.float64)
    weight = np.array([totals[int(t)] / max(1, (toxic == t).sum()) for t in toxic])
    words, cut = _flat(chosen["terms"], np.uint64)
    times, _ = _flat(chosen["times"], np.int32)
    del chosen

    # Every word of an example is a term; those whose document frequencies differ weigh more.  Arrays
    # as long as the sample's words are few and flat: the driver has little memory.
    terms = np.unique(words)
    place = np.empty(len(words), np.int32)
    n1, n0 = float((toxic == 1).sum()), float((toxic == 0).sum())
    row, d1 = np.zeros(len(terms)), np.zeros(len(terms))
    for at in range(0, len(ids), 256):
        low, high = cut[at], cut[min(at + 256, len(ids))]
        place[low:high] = np.searchsorted(terms, words[low:high])
        row += np.bincount(place[low:high], minlength=len(terms))
        d1 += np.bincount(place[low:high], np.repeat(toxic[at : at + 256], np.diff(cut[at : at + 257])), len(terms))
    del words
    d0 = row - d1
    n = n1 + n0
    chi = n * (d1 * (n0 - d0) - d0 * (n1 - d1)) ** 2 / np.maximum(row * (n - row) * n1 * n0, 1e-9)
    # Up to the largest value expected by chance among all terms, the factor stays near 1.
    factor = 1 + chi / (2 * np.log(max(len(terms), 2)) + 2)

    def frequencies(batches):
        count, texts_ = np.zeros(len(terms), dtype=np.int64), 0
        names = ["tid", "term", "times", "copies"]
        for batch in batches:
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            texts_ += len(texts)
            for low, high in slices(texts):
                (_, place, _), (text, term, times) = _counts(texts[low:high], terms)
                count += np.bincount(place, minlength=len(terms))
                tid = batch.column("tid").slice(low, high - low).take(pa.array(text))
                copies = pa.array(np.ones(len(text), np.int64))
                yield pa.RecordBatch.from_arrays([tid, pa.array(term.view(np.int64)), pa.array(times), copies], names)
        place = np.r_[np.flatnonzero(count), -1]
        times = np.r_[count[count > 0], texts_]
        none = pa.nulls(len(place), pa.binary())
        yield pa.RecordBatch.from_arrays([none, pa.array(place), pa.array(np.zeros(len(place), np.int64)), pa.array(times)], names)

    # Rows without tid count the terms, the others are the words outside of them by text.
    outside = _named(documents).select("tid", "text").mapInArrow(frequencies, "tid binary, term long, times long, copies long")
    outside = outside.groupBy("tid", "term").agg(F.max("times").alias("times"), F.sum("copies").alias("copies"))
    outside = written(outside, "outside")
    counted = outside.where("tid is null").select("term", "copies").toArrow()
    df = np.zeros(len(terms) + 1, dtype=np.int64)  # the last is the number of texts
    df[counted["term"].to_numpy()] = counted["copies"].to_numpy()
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * factor
    weights = np.empty(len(place))
    for a, b in zip(cut[:-1], cut[1:]):
        if a < b:
            weights[a:b] = unit(times[a:b], idf[place[a:b]])
    del times
    released()
    rows = [(place[a:b], weights[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    model = Model(terms, idf, ids, toxic, weight, rows, k)
    outside = outside.where("tid is not null")
    rest = outside.groupBy("term").agg(F.sum("copies").alias("df"))
    length = (1 + F.log("times")) * (F.log(F.lit(1.0 + df[-1]) / (1 + F.col("df"))) + 1)
    model.outer = outside.join(rest, "term").groupBy("tid").agg(F.sum(length * length).alias("outer"))
    return model


def _named(documents: DataFrame) -> DataFrame:
    return documents.withColumn("tid", F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All rows with score (0 to 1) and evidence (doc_ids of the nearest examples).

    ``documents`` are those of the model's fit.  Only the text is read; null counts as empty,
    and a text without any word gets the toxic share of such examples.  Input columns of the added
    names are replaced.
    """
    rest = [c for c in documents.columns if c not in ("score", "evidence")]
    return _scored(documents.select(*rest), model, rest)


def _scored(documents: DataFrame, model: Model, rest: list[str]) -> DataFrame:
    """``rest``, score and evidence of documents; a text that is not in ``rest`` is not shuffled."""
    name = uuid4().hex
    shared = documents.sparkSession.sparkContext.broadcast(model.state())

    def run(batches):
        known = _revived(name, shared.value)
        for batch in batches:
            texts = [(t or "").lower().encode() for t in batch.column("_text").to_pylist()]
            found, bare = [], []
            for low, high in slices(texts):
                (text, term, times), (others, _, _) = _counts(texts[low:high], known.terms)
                cut = np.searchsorted(text, np.arange(high - low + 1))
                found += [known.search(term[a:b], times[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                bare.append(np.bincount(text, minlength=high - low) + np.bincount(others, minlength=high - low) == 0)
            out = batch.drop_columns(["_text"])
            for column, values in zip(("_inner", "_pull", "_toxic", "evidence"), list(zip(*found)) or [[]] * 4):
                out = out.append_column(column, pa.array(values, pa.list_(pa.int64()) if column == "evidence" else pa.float64()))
            yield out.append_column("_bare", pa.array(np.concatenate(bare or [np.empty(0, bool)]), pa.bool_()))

    shape = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in rest)
    body = F.coalesce("text", F.lit(""))
    rows = documents.select(*rest, F.unhex(F.md5(body)).alias("_tid"), body.alias("_text"))
    rows = rows.mapInArrow(
        run, f"{shape}_tid binary, _inner double, _pull double, _toxic double, evidence array<long>, _bare boolean"
    )
    outer = model.outer.select(F.col("tid").alias("_tid"), F.col("outer").alias("_outer"))
    joined = rows.join(outer.hint("merge"), "_tid", "left")
    # The votes were those of the known terms alone; the whole vector is longer.
    shrink = F.when(F.col("_inner") > 0, F.sqrt(F.col("_inner") / (F.col("_inner") + F.coalesce("_outer", F.lit(0.0))))).otherwise(0.0)
    share = (shrink * F.col("_toxic") + model.prior) / (shrink * F.col("_pull") + 1)
    share = F.greatest(F.least(share, F.lit(1 - 1e-6)), F.lit(1e-6))
    chance = 1 / (1 + F.exp(-model.a * F.log(share / (1 - share)) - model.b))
    return joined.select(*rest, F.when(F.col("_bare"), model.bare).otherwise(chance).alias("score"), "evidence")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels to learn from: those whose crc32(doc_id) is not 1 modulo 3."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every document."""
    model = fit(documents, learnable(labels), **options)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return _scored(documents.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence"
    )


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The documents below the threshold, with their columns."""
    model = fit(documents, learnable(labels), **options)
    return score(documents, model).where(F.col("score") < threshold).select(*documents.columns)
