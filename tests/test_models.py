"""The model graph: stored builds agree with plans, and each model reads stored ones."""

import re

from test_gold import AS_OF, silver  # noqa: F401  (a fixture)

from garimpo.plans import gold as G
from garimpo.sources.tables import stored_in


def rows(df):
    return sorted(map(str, df.collect()))


def test_stored_models_are_built_once_from_stored_ones(spark, silver, tmp_path):  # noqa: F811
    built, scans = {}, {}
    keep_ = stored_in(str(tmp_path))

    def keep(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scans[name] = len(re.findall(r"(?<!Local)Relation \[", plan))
        built[name] = built.get(name, 0) + 1
        return keep_(df, name)

    stored = G.build_gold(spark, silver, AS_OF, keep)
    planned = G.build_gold(spark, silver, AS_OF)
    assert list(stored) == list(planned) and set(built.values()) == {1}
    for name in planned:
        assert stored[name].columns == planned[name].columns and rows(stored[name]) == rows(planned[name]), name
    # Relations read from files: one for each model that is read, none of them twice.
    assert scans == {name: sum(r not in ("jobs", "companies", "locations") for r in m.reads) for name, m in G.models(spark, AS_OF).items()}
    assert len(list(tmp_path.iterdir())) == 14


def test_models_come_after_what_they_read(spark):
    seen = {"jobs", "companies", "locations"}
    for name, model in G.models(spark, AS_OF).items():
        assert set(model.reads) <= seen
        seen.add(name)
