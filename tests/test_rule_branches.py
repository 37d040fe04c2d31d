"""Every value of the classification rules occurs in a query that is compared with SQL."""

from __future__ import annotations

import pytest
from conftest import DATA

from garimpo.queries import REGISTRY

EXPECTED = {
    ("classify_titles", "area"): {
        "ml_mlops", "data_engineering", "data_science", "data_analytics", "bi", "non_tech", "non_data", None,
    },
    ("classify_titles", "seniority"): {"lead", "estagio", "junior", "pleno", "senior", None},
    ("countries_of_places", "country_code"): {"GB", "CA", "CL", "US", "BR", "Global"},
    ("categories_of_skills", "primary_category"): {
        "data_engineering", "data_science", "analytics_bi", "ml_mlops", "cross_area",
    },
}


@pytest.mark.parametrize(("name", "column"), EXPECTED)
def test_every_value_occurs(spark, name, column):
    found = REGISTRY[name].run(spark, DATA).select(column).distinct().collect()
    assert {row[0] for row in found} == EXPECTED[name, column]


def test_landing_files_follow_the_rows(spark, tmp_path):
    """One source-day is split by size, not by a fixed number of tasks."""
    from garimpo.sources import envelopes as E

    def files(n):
        rows = spark.range(n).selectExpr(
            "'a' AS source", "DATE '2024-01-01' AS ds", "TIMESTAMP '2024-01-01 00:00:00' AS extracted_at",
            "sha2(CAST(id AS STRING), 512) AS payload",
        )
        root = str(tmp_path / f"landing{n}")
        E.write_landing(rows, root)
        assert E.read_landing(spark, root).count() == n
        return len(list((tmp_path / f"landing{n}").rglob("*.parquet")))

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        assert files(1000) < files(100_000)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
