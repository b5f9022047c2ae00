import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pricewatch.session import build_session, remove_written, tune

    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    remove_written(session)


@pytest.fixture(scope="session")
def column_of(spark):
    """Evaluate a column function on text rows; the results come back in input order."""
    from pyspark.sql import functions as F

    def evaluate(function, rows, schema="text string"):
        tuples = [row if isinstance(row, tuple) else (row,) for row in rows]
        names = [part.split()[0] for part in schema.split(", ")]
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(tuples)], f"__i int, {schema}")
        out = df.select("__i", function(*(F.col(n) for n in names)).alias("v")).orderBy("__i").collect()
        return [row.v for row in out]

    return evaluate
