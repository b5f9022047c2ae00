"""Built captures: bodies stay where their pages are, and a job builds them once."""

import pytest

from pricewatch.bindings.responses import bodies
from pricewatch.plans import catalogue


def flat(spark):
    rows = [(i, 2025 + i % 2, i // 96, str(100000 + i), "Sony", 2025 + i % 2, 55, 900.0 + i, "nok") for i in range(400)]
    names = "o_orderkey long, year int, page_index int, sku string, brand string, facet_year int, inches int, amount double, currency string"
    return spark.createDataFrame(rows, names)


def test_no_shuffle_brings_a_year_to_one_task(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from pyspark.sql import functions as F

        rows = bodies(flat(spark), F.lit(False))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert rows.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gates_and_items_read_responses_that_are_built_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    read = {}

    def noted(rows, name, written=catalogue.written):
        read[name] = rows.inputFiles()
        return written(rows, name)

    monkeypatch.setattr(catalogue, "written", noted)
    with pytest.raises(catalogue.CatalogueRejected):
        catalogue.api_items(bodies(flat(spark), F.lit(False)))
    for name in ("api-pages", "api-hits"):
        assert read[name] and all("/api-responses-" in f for f in read[name])
