"""What the driver does besides planning: rounds of components, arrays of the toxicity fit."""

import platform
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

from garimpo.llm import shared, toxicity
from garimpo.llm.shared import components, united


@pytest.mark.parametrize("links, tables", [
    ([], 1),
    ([(5, 5)], 1),
    ([(1, 2), (3, 1), (3, 1), (9, 7), (7, 8)], 1),  # stars around their least nodes
    ([(1, 2), (2, 3)], None),
    ([(4, 2), (4, 3)], None),
])
def test_stars_take_no_round(spark, monkeypatch, links, tables):
    names = []

    def counted(df, name):
        names.append(name)
        return written(df, name)

    written = shared.written
    monkeypatch.setattr(shared, "written", counted)
    found = sorted(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    nodes = sorted({n for a, b in links if a != b for n in (a, b)})
    label = united(10, np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
    assert found == [(n, label[n]) for n in nodes]
    assert tables is None or len(names) == tables


def test_components_of_random_links(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 400, (2, 300))
    chain = np.arange(400, 440)
    a, b = np.r_[a, chain[1:]], np.r_[b, chain[:-1]]
    rows = components(spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")).collect()
    label = united(440, a, b)
    nodes = sorted({n for x, y in zip(a.tolist(), b.tolist()) if x != y for n in (x, y)})
    assert sorted(tuple(r) for r in rows) == [(n, label[n]) for n in nodes]


def test_building_an_index_takes_little_besides_it():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(1000):
        terms = np.unique(np.r_[rng.integers(0, 30, 20), rng.integers(0, 10000, 230)]).astype(np.int32)
        rows.append((terms, rng.random(len(terms))))
    tracemalloc.start()
    try:
        toxicity.Index(rows, 10000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * sum(len(t) for t, _ in rows)  # 50 bytes a word before


def test_fit_joins_the_words_of_its_sample_once(spark):
    docs = spark.createDataFrame([(3, "b a b"), (1, "a, c"), (2, None), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.ids.tolist() == [1, 2, 3] and model.toxic.tolist() == [0, 0, 1]
    assert len(model.terms) == 3 and model.held.tolist() == [0, 2]
    full = np.zeros((3, 3))
    for i, text in ((0, b"a c"), (2, b"b a b")):
        (_, place, times), _ = toxicity._counts([text], model.terms)
        full[i, place] = toxicity.unit(times, model.idf[place])
        found = model.index.nearest(place, full[i, place], 15)
        assert found[0][0] == pytest.approx(1)
    assert toxicity.fit(docs, labels.where("false")).index.size == 0


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only glibc is asked to give memory back")
def test_what_the_driver_has_freed_goes_back_before_a_table_is_written(spark):
    def held():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    arrays = [np.ones(10_000) for _ in range(1600)]  # 128 MB in pieces that malloc keeps
    arrays = arrays[::100]
    before = held()
    shared.written(spark.range(1), "one").count()
    assert len(arrays) == 16 and held() < before - 60
