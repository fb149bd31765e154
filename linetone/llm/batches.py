"""How many texts a Python worker holds."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 500

_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python in batches of at most ``ROWS``.

    The default of 10,000 suits numbers; as many texts, and Spark's own copy of them, are a
    large part of an executor's memory. A smaller setting stays as it is.
    """
    now = int(spark.conf.get(_SETTING))
    if now <= 0 or now > ROWS:
        spark.conf.set(_SETTING, ROWS)
