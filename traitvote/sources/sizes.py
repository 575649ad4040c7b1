"""How many tasks a shuffle is dealt to."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows that a task sorts or counts at a time, some 100 to 200 MB.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks of ``TASK_ROWS`` rows each, or None where Spark's own number gives fewer rows.

    Spark goes by compressed bytes: its 64 MB of short columns are millions of
    rows, which take a sort or an aggregate a GB. A number asked for stays.
    """
    usual = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = -(-rows // TASK_ROWS)
    return tasks if tasks > usual else None
