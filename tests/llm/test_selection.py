"""Filter audit, source mixing and hard negatives against brute force, on small rows with every odd case."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest

from garimpo.llm import filter_audit, hard_negatives, mixing
from garimpo.llm.shared import bodies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, words, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text, lang, source): copies, nulls, empties, long texts and words, repeated rows, null ids."""
    rng = random.Random(5)
    plain = prose(rng, 260, 2000)
    out = [
        (0, plain, "en", "a"), (1, plain, "en", "b"), (2, plain, None, None), (2, plain, None, None), (None, plain, "en", "a"),
        (3, None, "en", "a"), (4, "", "", "a"), (5, " \t\n\v\f\r ", "fr", "b"), (6, prose(rng, 300, 100), "fr", "b"),
        (7, "AB " + plain, "fr", "é"), (8, "ABCDEFGH " * 120, "en", "b"), (9, plain + " 5%", "en", "\U0001F600"),
        (10, "ü ß x 日本 語 " * 70, "de", "～"), (11, "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5000, "de", "a"),
        (12, prose(rng, 30_000), "de", "a"), (13, "a" * 70 + "b " + "a" * 70 + "c", "de", ""), (-4, "one two", "en", "b"),
    ]
    return out + [(20 + i, prose(rng, rng.randrange(400)), rng.choice(["en", "fr"]), rng.choice("abc")) for i in range(60)]


SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = SCHEMA + ", size int, mask string, part double, weight string, mix_key int, target string"


def frame(spark, texts):
    return spark.createDataFrame([(*t, 1, "m", 0.5, "w", 3, "t") for t in texts], CLASHING).repartition(4)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(0, 1, 1), (1, 0, 1), (2, 1, 0), (2, 0, 1), (5, 1, None), (6, None, None), (None, 1, 1), (999, 1, 1), (12, 1, 1)]
    return spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, quality int, toxic int, lang string")


def test_transducer_against_patterns(spark, texts):
    rows = filter_audit.measure(frame(spark, texts), slice_bytes=5000).collect()
    got = collections.Counter(tuple(r)[:7] for r in rows)
    want = collections.Counter()
    for i, text, lang, _ in texts:
        t = text or ""
        words = WORD.findall(t)
        want[i, lang, len(words), len(set(words)), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t)), len(t)] += 1
    assert got == want


def test_equal_hashes_are_verified(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(filter_audit, "mixed", lambda values, seed=0: np.zeros(len(values), np.uint64))
    texts = ["a b a c ab", "a b", "", "x" * 100 + "y " + "x" * 100 + "z", "longer-than-eight longer-than-nine longer-than-eight"]
    data, offsets = bodies(pa.array(texts))
    _, owner, start, end = filter_audit.transduce(data, offsets)
    assert filter_audit.distinct_words(data, owner, start, end, len(texts)).tolist() == [4, 2, 0, 2, 2]


def brute_audit(texts, marks):
    masks = []
    least = {}
    for i, text, *_ in texts:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, lang, _ in texts:
        t = text or ""
        words = WORD.findall(t)
        fails = "".join(
            c for c, f in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t],
            )) if f
        )
        masks.append((lang or "", fails, *marks.get(i, (0, 0))))
    out = {}
    for part in {m[0] for m in masks}:
        removed_by = collections.Counter()
        rows = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, c in enumerate(order, 1):
                ahead = set(order[: step - 1])
                here = [m for m in masks if m[0] == part]
                removed = [m for m in here if c in m[1] and not ahead & set(m[1])]
                rows[order, step] = [
                    sum(not (ahead | {c}) & set(m[1]) for m in here), len(removed),
                    sum(c in m[1] and bool(ahead & set(m[1])) for m in here), sum(m[1] == c for m in here),
                    sum(m[2] for m in removed), sum(m[3] for m in removed),
                ]
                removed_by[c] += len(removed)
        for (order, step), counts in rows.items():
            out[part, order, step] = (*counts, removed_by[order[step - 1]])
    return out


def test_audit(spark, texts, labels):
    marks = {0: (1, 1), 1: (0, 1), 2: (1, 1), 5: (1, 0), 12: (1, 1)}
    rows = filter_audit.audit(frame(spark, texts), labels).collect()
    assert len(rows) == 120 * 5 * 4
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rows} == brute_audit(texts, marks)


def test_audit_of_nothing(spark, labels):
    empty = spark.createDataFrame([], CLASHING)
    assert filter_audit.audit(empty, labels).count() == 0
    one = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    rows = filter_audit.audit(one, labels.limit(0)).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.filter_order[r.step - 1], r.shapley) for r in rows} == {("A", 120), *((c, 0) for c in "BCDE")}


# --- mixing -----------------------------------------------------------------------
def filled(sizes, weights, total, epochs):
    """Targets by clamping one round after the other."""
    clamped = set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        weight = sum(weights[s] for s in sizes if s not in clamped)
        target = {s: epochs * sizes[s] if s in clamped else rest * weights[s] / weight for s in sizes}
        above = {s for s in sizes if s not in clamped and target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


def test_mix(spark, texts):
    found = mixing.mix(frame(spark, texts)).collect()
    assert len(found) == len(texts)
    size = {t[0]: len(WORD.findall(t[1] or "")) for t in texts}
    names = sorted({t[3] for t in texts if t[3] is not None}) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(len(WORD.findall(t[1] or "")) for t in texts if t[3] == s) for s in names}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = collections.Counter()
    for r in found:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[r.source])
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r.size and r.whole * r.size <= r.taken
        taken[r.source] += r.taken
    for s in names:  # two equal rows may share an odd word
        assert math.floor(want[s]) - 1 <= taken[s] <= want[s]
    again = mixing.mix(frame(spark, texts).repartition(2)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, found))
    other = mixing.mix(frame(spark, texts), seed="other").collect()
    assert collections.Counter(map(tuple, other)) != collections.Counter(map(tuple, found))


def test_mixed_texts_have_the_words(spark, texts):
    docs = frame(spark, texts)
    words = collections.Counter()
    for r in mixing.mixture(docs).collect():
        words[r.doc_id] += len(WORD.findall(r.text or ""))
        source = {t[1] or "" for t in texts if t[0] == r.doc_id}
        assert any(s.startswith(r.text) for s in source)
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.taken
    assert +words == +want


def test_capped_water_filling(spark):
    rows = [("a", 10, 3), ("b", 1000, 1), ("c", 5, 2), ("d", 300, 3), ("e", 0, 1), (None, 40, 2)]
    sources = spark.createDataFrame(rows, "source string, source_size long, weight int")
    for share, epochs in ((1.5, 2.0), (0.1, 2.0), (2.0, 2.0), (5.0, 2.0), (0.0, 1.0), (1.0, 1.0)):
        got = {r.source: r.target for r in mixing.water_fill(sources, share, epochs).collect()}
        total = min(share, epochs) * sum(r[1] for r in rows)
        assert math.isclose(sum(got.values()), total, abs_tol=1e-6)
        assert all(got[s] <= epochs * n + 1e-9 for s, n, _ in rows)
        level = max((got[s] / w for s, n, w in rows), default=0)
        for s, n, w in rows:  # below its cap a source stands at the common level
            assert got[s] >= epochs * n - 1e-9 or math.isclose(got[s] / w, level, abs_tol=1e-9)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    none = mixing.mix(spark.createDataFrame([(1, None, "en", None), (2, " ", "en", "x")], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2


# --- hard negatives ---------------------------------------------------------------
def brute_negatives(rows, anchors, positives=5, negatives=10, scale=256.0):
    rows = [
        (i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, label, v in rows:
        if anchors(i):
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    out = collections.Counter()
    for i, (label, v) in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i)
        for p in [(-s, j) for s, j, other in scored if other == label][:positives]:
            fits = [(j, -s) for s, j, other in scored if other != label and 30 * p[0] <= -100 * s <= 90 * p[0]]
            for rank, (j, s) in enumerate(fits[:negatives], 1):
                out[i, p[1], rank, j, p[0], s] += 1
    return out


def vectors(spark, rows, label="int"):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, label {label}, embedding array<float>, shard int, id string")


def random_rows(seed, n, dims, labels, spread):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(labels, dims))
    at = rng.integers(0, labels, n)
    held = np.round((base[at] + spread * rng.normal(size=(n, dims))) * np.exp(rng.normal(size=(n, 1))), 2)
    return [(int(i), int(label), [float(np.float32(x)) for x in v]) for i, (label, v) in enumerate(zip(at, held))]


@pytest.mark.parametrize(
    "seed, dims, labels, spread, options",
    [(1, 6, 3, 0.7, {}), (2, 16, 4, 2.0, {"focus": 1}), (3, 3, 2, 0.1, {"tile_bytes": 480, "least_rows": 20, "bucket_rows": 7})],
)
def test_hard_negatives(spark, seed, dims, labels, spread, options):
    rows = random_rows(seed, 400, dims, labels, spread)
    rows += [(i, label, v) for i, label, v in rows[:60]]  # repeated rows, anchors among them
    rows += [(500 + i, (label + 1) % labels, v) for i, label, v in rows[:40]]  # equal scores
    rows += [
        (700, None, rows[0][2]), (None, 0, rows[0][2]), (710, 0, None), (720, 0, []), (730, 1, [0.0] * dims),
        (740, 0, [float("nan")] * dims), (750, 1, [float("inf")] * dims), (760, 1, [None] * dims), (770, 0, rows[0][2][:2]),
        (780, labels, rows[0][2]), (-10, 0, rows[1][2]),
    ]
    got = hard_negatives.hard_negatives(vectors(spark, rows), hard_negatives.F.col("vec_id") % 10 == 0, **options).collect()
    assert collections.Counter(map(tuple, got)) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_edges(spark):
    every = hard_negatives.F.col("vec_id") >= 0
    empty = hard_negatives.hard_negatives(vectors(spark, []), every)
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert empty.count() == 0
    huge = [(0, 0, [3e18, 1.0]), (1, 0, [2e18, 1.0]), (2, 1, [1e18, -1.0]), (3, 1, [0.25, 2.0])]
    far = hard_negatives.hard_negatives(vectors(spark, huge), every)
    assert {(r.anchor_id, r.positive_id) for r in far.collect()} <= {(0, 1), (1, 0), (2, 3), (3, 2)}
    rows = random_rows(9, 120, 4, 2, 0.5)
    named = [(i, "ab"[label], v) for i, label, v in rows]
    got = hard_negatives.hard_negatives(vectors(spark, named, "string"), every).collect()
    assert collections.Counter(map(tuple, got)) == brute_negatives(rows, lambda i: True)


def test_coordinate_ranges_prune():
    """Clustered directions: most rows fall out before any score, and none that reaches the bound does."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 12))
    rows = np.floor(256 * (centres[rng.integers(0, 20, 2000)] + 0.05 * rng.normal(size=(2000, 12))))
    lengths = np.sqrt((rows * rows).sum(axis=1))
    bucket = hard_negatives.Bucket(np.arange(2000), np.zeros(2000), rows, lengths)
    units = rows[:50] / lengths[:50, None]
    focus = np.argsort(-np.abs(units), axis=1)[:, :3]
    alive = bucket.possible(units, focus, np.full(50, 0.95))
    cosine = units @ (rows / lengths[:, None]).T
    assert alive[cosine >= 0.95].all()
    assert alive.mean() < 0.3
