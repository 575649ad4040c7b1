"""Tables written between the steps of a build."""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the session shares for checkpoints, however it was set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.sparkContext.getCheckpointDir()


class Stages:
    """Parquet tables in the folder the cluster shares for checkpoints.

    A step used more than once is written and read back: its lineage ends
    there, a lost executor costs no recomputation before it, and Spark knows
    its exact size when it chooses between a broadcast and a shuffle.

    The folder is ``root``, or what ``spark.checkpoint.dir`` or
    ``setCheckpointDir`` names. Without any, a local session gets a temporary
    folder that goes when Python ends; a cluster has to name one, and every
    executor has to see it. ``delete`` removes the tables of these stages, as
    does the end of a ``with`` block; what was read from them is then gone.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        root = root or shared_folder(spark)
        if root is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="traitvote-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        self._spark = spark
        self._tables: list[str] = []
        self._numbers = itertools.count()
        #: What was observed of a table while it was written, by its name.
        self.observed: dict[str, dict[str, object]] = {}
        self.path = f"{root.rstrip('/')}/traitvote-{uuid.uuid4().hex}"

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *error: object) -> None:
        self.delete()

    def delete(self) -> None:
        """Remove all tables written here, if there are any."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        configuration = self._spark.sparkContext._jsc.hadoopConfiguration()
        for table in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        with suppress(FileNotFoundError):
            path.getFileSystem(configuration).delete(path, True)

    def fresh(self, name: str) -> str:
        """A name for a table that these stages have not used yet."""
        return f"{name}_{next(self._numbers)}"

    def keep(self, name: str) -> Callable[[DataFrame], DataFrame]:
        """A function that writes what it gets under a name of its own."""
        return lambda df: self.write(self.fresh(name), df)

    def write(
        self,
        name: str,
        df: DataFrame,
        *folders: str,
        metrics: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Write ``df`` and return the written table.

        ``folders`` are columns whose values get a folder of their own, so that
        a filter on them decides which files are read. ``metrics`` are aggregates
        of the rows that the job finds on its way; see ``observed``.
        """
        path = f"{self.path}/{name}"
        rows = df
        if metrics:
            observation = Observation()
            rows = df.observe(observation, *(m.alias(n) for n, m in metrics.items()))
        rows.write.partitionBy(*folders).parquet(path)
        if metrics:
            self.observed[name] = observation.get
        return self._spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """Write ``df`` dealt to buckets by ``key`` and sorted in them.

        Two tables with the same number of buckets are joined on their keys
        without a shuffle of either. The table is known to the session's
        catalogue until it is deleted.
        """
        table = f"traitvote_{uuid.uuid4().hex}"
        path = f"{self.path}/{name}"
        dealt = df.repartition(buckets, key).write.format("parquet").option("path", path)
        dealt.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        self._tables.append(table)
        return self._spark.table(table)

    def write_all(
        self, tables: Mapping[str, DataFrame], metrics: Mapping[str, Column] | None = None
    ) -> dict[str, DataFrame]:
        """Write tables that do not depend on each other at the same time."""
        if not tables:
            return {}

        @inheritable_thread_target(self._spark)
        def write(name: str, df: DataFrame) -> DataFrame:
            return self.write(name, df, metrics=metrics)

        with ThreadPoolExecutor(len(tables)) as pool:
            return dict(zip(tables, pool.map(write, tables, tables.values()), strict=True))
