"""Large windows and stored models: what is compared, dealt out and computed only once."""

import numpy as np
from conftest import DATA
from test_resolve import random_nodes, slow_leaders

from garimpo.functions.similarity import Keys, TextSet
from garimpo.operators import resolve as R
from garimpo.queries.registry import REGISTRY
from garimpo.sources import tables as T

SCHEMA = "kid string, window string, title_k string, company_k string, forced boolean, ord string"


def test_titles_are_compared_once_however_often_they_occur(monkeypatch):
    seen, grid = [], TextSet.grid

    def counted(self, rows, others, threshold):
        if threshold == 85:
            seen.append(len(rows) * len(others))
        return grid(self, rows, others, threshold)

    monkeypatch.setattr(TextSet, "grid", counted)
    rng = np.random.default_rng(1)
    titles = ["".join(rng.choice(list("abcdefghij"), 12)) for _ in range(40)]
    names = ["".join(rng.choice(list("abcdefghij"), 12)) for _ in range(60)]
    rows = [(t, c) for t in titles for c in names]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    none = np.zeros(len(rows), dtype=bool)
    chosen, leads = Keys([t for t, _ in rows], [c for _, c in rows], 85, 90).assign(none, none)
    nodes = [(str(i), "", t, c, False, f"{i:06}") for i, (t, c) in enumerate(rows)]
    assert {str(i): str(c) for i, c in enumerate(chosen)} == slow_leaders(nodes)
    assert sum(seen) <= len(titles) ** 2


def test_a_window_of_7000_nodes_is_one_group(spark, monkeypatch):
    monkeypatch.setattr(R, "company_components", None)
    rows = [(f"{t}-{c}", "w", f"{t * 7919:05} title", f"{c * 7907:06} name", False, f"{t:03}{c:03}") for t in range(70) for c in range(100)]
    nodes = spark.createDataFrame(rows, SCHEMA)
    assert R.assign_leaders(nodes).count() == 7000


def test_shares_of_few_titles_match_the_loop(spark):
    rows = random_nodes(11, 150)
    rows = [(k, "w", t, c, f, o) for k, _, t, c, f, o in rows]
    nodes = spark.createDataFrame(rows, SCHEMA)
    limits = R.Limits(group_nodes=2, block_companies=2, first_peel=2, most_peel=8, share_nodes=5)
    assert dict(map(tuple, R.assign_leaders(nodes, limits=limits).collect())) == slow_leaders(rows)


def test_tied_names_are_not_compared_again(spark, monkeypatch):
    asked, reach = [], R.token_ratio_reaches

    def counted(a, b, threshold):
        asked.append(threshold)
        return reach(a, b, threshold)

    monkeypatch.setattr(R, "token_ratio_reaches", counted)
    names = spark.createDataFrame([(f"supplier {i:04} of {w}",) for i in range(60) for w in ("alpha", "omega")], "company_k string")
    found = {r["company_k"]: r["component"] for r in R.company_components(names).collect()}
    assert len(asked) == 2 and len(set(found.values())) <= 2


def test_materialise_reads_the_silver_tables_once(spark, monkeypatch):
    reads, write = {}, T.write_table

    def noted(df, root, name, *rest):
        reads[name] = {path.split("/")[-1] for path in df.inputFiles() if DATA in path}
        return write(df, root, name, *rest)

    monkeypatch.setattr(T, "write_table", noted)
    assert REGISTRY["materialise"].run(spark, DATA).count() == 5
    assert sum("lineitem.parquet" in r for r in reads.values()) == 1
