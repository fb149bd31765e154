from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("linetone-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def phrases(spark):
    """A ``movieId, line_no, Phrase`` table from ``(movieId, Phrase)`` pairs."""

    def build(pairs, partitions=1):
        rows = [(m, i, p) for i, (m, p) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "movieId long, line_no long, Phrase string")
        return df.repartition(partitions)

    return build


def rows(df, *columns):
    """Rows as sorted tuples of ``columns`` (all, if none are named)."""
    picked = df.select(*columns) if columns else df
    as_tuples = [
        tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in picked.collect()
    ]
    return sorted(as_tuples, key=repr)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
