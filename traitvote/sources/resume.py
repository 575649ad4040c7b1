"""Stage tables that a broken run leaves behind and the next one goes on from."""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

from .stages import Stages, shared_folder

PACKAGE = Path(__file__).resolve().parent.parent
#: Files whose size and time are looked at in one call.
LISTED = 10_000
_FIELDS, _MANY = "spark.sql.debug.maxToStringFields", str(2**31 - 1)
_WHOLE_TEXT = threading.Lock()
#: Nodes of a plan whose work its text does not tell.
_OPAQUE = re.compile(r"Python|Pandas|Arrow|subquery#|ScalaUDF|ExistingRDD|LogicalRDD")


def _hash(*parts: str) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(f"{len(part)}:{part}".encode())
    return digest.hexdigest()


def code_version(package: Path = PACKAGE) -> str:
    """A digest of the library's own code: other code, other stages."""
    files = sorted(package.rglob("*.py"))
    return _hash(*(f"{f.relative_to(package)}\n{f.read_text()}" for f in files))


def _files_of(location) -> str:
    """Paths, sizes and times of the files of a relation."""
    files = location.allFiles()
    parts = []
    for start in range(0, files.size(), LISTED):
        text = files.slice(start, start + LISTED).mkString("\n")
        for line in text.split("\n"):
            path, size, time = (
                re.search(rf"{key}=([^;]*);", line)[1] for key in ("path", "length", "modification_time")
            )
            parts.append(f"{path} {size} {time}")
    return _hash(*sorted(parts))


def _text_of(spark: SparkSession, plan) -> str:
    """The plan as text, with nothing left out."""
    with _WHOLE_TEXT:
        before = spark.conf.get(_FIELDS)
        spark.conf.set(_FIELDS, _MANY)
        try:
            return plan.canonicalized().toString()
        finally:
            spark.conf.set(_FIELDS, before)


def fingerprint(df: DataFrame) -> str | None:
    """A digest of what ``df`` computes and of what it reads, if both can be seen.

    That is the plan with all its literals, the schema, the rows of small
    tables made in memory, and path, size and time of every input file. A plan
    with Python functions, or that reads anything but files, gives None.
    """
    plan = df._jdf.queryExecution().analyzed()
    text = _text_of(df.sparkSession, plan)
    if _OPAQUE.search(text):
        return None
    read, leaves = [], plan.collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            relation = leaf.relation()
            read.append(_files_of(relation.location()))
            read.append(relation.fileFormat().getClass().getName())
            read.append("\n".join(sorted(relation.options().mkString("\n").split("\n"))))
        elif kind == "LocalRelation":
            read.append(_hash(leaf.data().mkString("\n")))
        elif kind not in ("Range", "OneRowRelation"):
            return None
        read.append(leaf.schema().json())  # the text has no names of columns
    return _hash(text, df.schema.json(), *read)


class ResumableStages(Stages):
    """Stages of a named run, so that the same work is not done twice.

    A finished table has a record under the fingerprint of what it was computed
    from: the plan, the input files, the library's code and ``version``, the
    caller's own word for all that a plan does not show. Asked to write the same
    again, in this session or a later one, the stages return the finished table
    without running a job. Since a table's input is often another one, a change
    of some input has everything computed again that depends on it, and nothing
    else.

    A record is written in one step, after its table is complete, and names
    the table's folder, which no other attempt writes to. So a run that is
    killed at any point leaves finished tables and folders without a record.
    ``prune`` removes these and what this run did not ask for; ``delete`` removes
    the whole run. Two runs of one name should not go on at the same time: they
    may do work twice, but neither harms the other's tables.
    """

    def __init__(
        self, spark: SparkSession, run: str, root: str | None = None, version: str = ""
    ) -> None:
        root = root or shared_folder(spark)
        if root is None:
            raise ValueError("a run that can be resumed needs root or spark.checkpoint.dir")
        super().__init__(spark, root)
        self.path = f"{root.rstrip('/')}/traitvote-run-{run}"
        self._version = _hash(code_version(), version)
        self._used: set[str] = set()
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)
        self._guard = threading.Lock()

    # --- Hadoop's file system, which Spark reads and writes with ---

    def _at(self, *parts: str):
        path = self._spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()), path

    def _read_record(self, key: str) -> dict | None:
        files, path = self._at("_records", f"{key}.json")
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_record(self, key: str, record: dict) -> None:
        """Under another name first: the rename is what makes it count."""
        files, draft = self._at("_records", f".{key}-{uuid.uuid4().hex}")
        stream = files.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
        finally:
            stream.close()
        final = self._at("_records", f"{key}.json")[1]
        files.delete(final, False)  # of a table that is gone
        if not files.rename(draft, final):
            raise OSError(f"cannot write {final}")

    def _size(self, table: str) -> list[int] | None:
        """Files and bytes of a table."""
        files, path = self._at(table)
        if not files.exists(path):
            return None
        summary = files.getContentSummary(path)
        return [summary.getFileCount(), summary.getLength()]

    def finished(self) -> list[str]:
        """The names of the tables that have a record, sorted."""
        files, path = self._at("_records")
        if not files.exists(path):
            return []
        keys = [s.getPath().getName() for s in files.listStatus(path)]
        records = [self._read_record(k.removesuffix(".json")) for k in keys if not k.startswith(".")]
        return sorted(record["name"] for record in records if record)

    def write(
        self,
        name: str,
        df: DataFrame,
        *folders: str,
        metrics: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Write ``df``, unless that has been done, and return the table.

        What has no fingerprint is written each time. Metrics are part of the
        record, so they are known again without a job.
        """
        own, table = fingerprint(df), f"{name}-{uuid.uuid4().hex}"
        if own is None:
            self._used.add(table)
            written = super().write(table, df, *folders, metrics=metrics)
            if metrics:
                self.observed[name] = self.observed.pop(table)
            return written
        asked = [f"{n}={m}" for n, m in sorted((metrics or {}).items())]
        key = _hash(own, self._version, *folders, *asked)
        with self._guard:
            lock = self._locks[key]
        with lock:  # two names may stand for the same work
            record = self._read_record(key)
            if record is None or self._size(record["table"]) != record["size"]:
                written = super().write(table, df, *folders, metrics=metrics)
                record = {"name": name, "table": table, "size": self._size(table)}
                record["observed"] = self.observed.pop(table, None)
                self._write_record(key, record)
            else:
                written = self._spark.read.schema(df.schema).parquet(f"{self.path}/{record['table']}")
        if metrics:
            self.observed[name] = record["observed"]
        self._used |= {record["table"], f"{key}.json"}
        return written

    def write_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """As ever: the session's catalogue does not outlast the session."""
        table = f"{name}-{uuid.uuid4().hex}"
        self._used.add(table)
        return super().write_bucketed(table, df, key, buckets)

    def prune(self) -> None:
        """Remove what was neither read nor written through these stages."""
        for folder in ((), ("_records",)):
            files, path = self._at(*folder)
            if files.exists(path):
                for status in files.listStatus(path):
                    if status.getPath().getName() not in self._used | {"_records"}:
                        files.delete(status.getPath(), True)
