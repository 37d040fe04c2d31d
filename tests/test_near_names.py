"""Names that are compared once and then met by number: the same leaders as by text, and only near names are looked at."""

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from test_resolve import PATHS, random_nodes, slow_leaders

from garimpo.functions.similarity import Keys, Near, NearKeys, TextSet
from garimpo.functions.text import sort_tokens
from garimpo.operators import resolve as R
from garimpo.queries.registry import REGISTRY

SCHEMA = "kid string, window string, title_k string, company_k string, forced boolean, ord string"


def near(texts, threshold):
    return Near(len(texts), *np.nonzero(np.triu(TextSet(texts).matrix(threshold), 1)))


def some_texts(rng, letters, low, high):
    return sorted({"".join(rng.choice(list(letters), rng.integers(low, high))) for _ in range(30)})


@pytest.mark.parametrize("bits", [0, 2**14])
def test_near_keys_assign_as_keys_do(monkeypatch, bits):
    monkeypatch.setattr(Near, "BITS", bits)
    rng = np.random.default_rng(5)
    for trial in range(12):
        titles, companies = some_texts(rng, "abc", 3, 12), some_texts(rng, "ab", 6, 14)
        least = (85 - trial, 90 - 2 * trial)
        near_titles, near_companies = near(titles, least[0]), near(companies, least[1])
        t, c = rng.integers(0, len(titles), 200), rng.integers(0, len(companies), 200)
        forced, settled = rng.random(200) < 0.15, rng.random(200) < 0.1
        monkeypatch.setattr(NearKeys, "CHUNK", (5, 50, 2**18)[trial % 3])
        monkeypatch.setattr(NearKeys, "OPEN", (1, 128)[trial % 2])
        by_number = NearKeys(t, c, near_titles, near_companies)
        by_text = Keys([titles[i] for i in t], [companies[i] for i in c], *least)
        chosen, leads = by_text.assign(forced, settled)
        for got, expected in zip(by_number.assign(forced, settled, (0, 7, 64)[trial % 3]), (chosen, leads)):
            assert (got == expected).all()
        leaders = np.flatnonzero(leads)
        assert (by_number.first_of(np.arange(200), leaders) == by_text.first_of(np.arange(200), leaders)).all()


def test_only_rows_of_near_names_are_looked_at(monkeypatch):
    asked, holds = [], Near.holds
    monkeypatch.setattr(Near, "holds", lambda self, a, b: asked.append(len(a)) or holds(self, a, b))
    rng = np.random.default_rng(6)
    names = sorted({"".join(rng.choice(list("abcdefghijklmnop"), 14)) for _ in range(500)})
    alone = near(names, 90)
    t, c = rng.integers(0, len(names), 4000), rng.integers(0, len(names), 4000)
    none = np.zeros(4000, dtype=bool)
    _, leads = NearKeys(t, c, alone, alone).assign(none, none)
    assert leads.sum() > 3900 and sum(asked) < 4000 * leads.sum() / 100


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("changed", [{"few_names": 0}, {"few_pairs": 0}, {"numbered": 1, "most_peel": 8, "share_nodes": 5}])
def test_leaders_by_text_and_by_number(spark, path, changed):
    rows = random_nodes(17, 90)
    nodes = spark.createDataFrame(rows, SCHEMA)
    found = R.assign_leaders(nodes, limits=PATHS[path]._replace(**changed))
    assert dict(map(tuple, found.collect())) == slow_leaders(rows)


def test_components_of_numbers():
    a, b = np.array([0, 1, 5]), np.array([3, 3, 6])
    assert Near(8, a, b).components().tolist() == [0, 0, 2, 0, 4, 5, 5, 7]
    assert Near(0, a[:0], b[:0]).components().tolist() == []


def test_postings_are_joined_and_folded_once(spark):
    for name in ("fuzzy_dedup", "fuzzy_dedup_undated"):
        read = REGISTRY[name].run(spark, DATA).inputFiles()
        assert read and not any("lineitem" in path for path in read)


def test_tokens_are_sorted_without_lambdas(spark):
    texts = ["b a", "one", "", "  b\t a\x0bc ", "\x1c\x1da\x1eb\x1f", "b\n\r\x0ca", "é a", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", sort_tokens(F.col("t")).alias("s"))
    ascii_space = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
    plain = [t and " ".join(sorted("".join(" " if x in ascii_space else x for x in t).split(" "))).strip() for t in texts]
    assert [r["s"] for r in frame.orderBy("i").collect()] == plain
    assert "lambda" not in frame._jdf.queryExecution().optimizedPlan().toString()
