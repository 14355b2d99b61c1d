"""Batch export job: run every registered builder, write one output each.

A failing entry is reported in its status row and the job goes on; a lost
session or connection is raised, like the reference's extraction loop does. Each output is written by the executors straight
to shared storage; the driver only sees the per-entry status.

A result is written to a staging folder first and takes the place of the old
one by renames, so a failed entry leaves the old result as it was. A manifest
per entry names the run that finished it; a run of the same name skips what is
finished. Folders of the export root:

    <name>/             the result, as readers see it
    _staging/<name>/    being written; a rest of a lost run is written anew
    _replaced/<name>/   the old result, only while the new one takes its place
    _manifest/<name>    JSON: run, format, rows, sort keys
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regiopanel.session import file_system

STATUS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("ok", T.BooleanType(), False),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("skipped", T.BooleanType(), False),
])


def _session_lost(spark: SparkSession, exc: Exception) -> bool:
    if isinstance(exc, (ConnectionError, Py4JNetworkError)):
        return True
    sc = spark.sparkContext
    return sc._jsc is None or sc._jsc.sc().isStopped()


class _Root:
    """The folders of one export root, by the shared file system's own calls."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def at(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, path: str) -> bool:
        fs, p = file_system(self.spark, path)
        return fs.exists(p)

    def drop(self, *parts: str) -> None:
        fs, p = file_system(self.spark, self.at(*parts))
        fs.delete(p, True)

    def move(self, src: str, dst: str) -> None:
        fs, to = file_system(self.spark, dst)
        fs.mkdirs(to.getParent())
        if not fs.rename(file_system(self.spark, src)[1], to):
            raise OSError(f"cannot move {src} to {dst}")

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        fs, p = file_system(self.spark, path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Written beside and renamed, so a reader finds the whole text or none."""
        beside = f"{path}-{uuid.uuid4().hex[:12]}"
        fs, p = file_system(self.spark, beside)
        stream = fs.create(p)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        fs.delete(file_system(self.spark, path)[1], False)
        self.move(beside, path)

    def recover(self, name: str) -> None:
        """Put the old result back if a run was lost between the two renames of :meth:`publish`."""
        old, new = self.at("_replaced", name), self.at(name)
        if self.exists(old):
            if self.exists(new):
                self.drop("_replaced", name)
            else:
                self.move(old, new)

    def publish(self, name: str) -> None:
        old, new, staged = self.at("_replaced", name), self.at(name), self.at("_staging", name)
        # The old manifest does not speak for the new result.
        self.drop("_manifest", name)
        if self.exists(new):
            self.move(new, old)
        try:
            self.move(staged, new)
        except Exception:
            self.recover(name)
            raise
        self.drop("_replaced", name)

    def finished(self, name: str, run: str, fmt: str, keys: list[str] | None) -> dict | None:
        """The manifest of ``name`` if this very run wrote the result that is there."""
        text = self.read_text(self.at("_manifest", name))
        if text is None or not self.exists(self.at(name)):
            return None
        entry = json.loads(text)
        same = (entry["run"], entry["format"], entry["sort_keys"]) == (run, fmt, keys)
        return entry if same else None


def run_export(spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]], out_root: str,
               fmt: str = "parquet", sort_keys: Mapping[str, list[str]] | None = None,
               sort_keys_present_only: bool = False, run: str | None = None) -> DataFrame:
    """Write each builder's result under ``out_root/<name>``; return status rows.

    ``sort_keys`` gives a result its ``ORDER BY``: a range-partitioned global
    sort, so part files are ordered among themselves and no task holds all
    rows. Row counts are read back from the written files rather than by
    re-running the query.

    ``run`` names the run, for instance a date. Entries which a run of that
    name, format and sort keys has finished are not built again (status
    ``skipped``); without a name every entry is built. An entry that fails
    keeps its old result, which then is not finished under the new name.
    Names are plain folder names; one that starts with ``_`` or ``.`` is refused,
    since readers take such folders for hidden. One export at a time may write to a root.
    """
    for name in builders:
        if not name or name[0] in "_." or "/" in name:
            raise ValueError(f"not a name of an export entry: {name!r}")
    root, rows = _Root(spark, out_root), []
    for name, build in builders.items():
        path = root.at(name)
        asked = (sort_keys or {}).get(name)
        t0 = time.time()
        try:
            root.recover(name)
            done = root.finished(name, run, fmt, asked) if run is not None else None
            if done:
                rows.append((name, True, done["rows"], round(time.time() - t0, 3), None, path, True))
                continue
            df = build()
            keys = asked
            if keys and sort_keys_present_only:
                keys = [k for k in keys if k in df.columns]
            if keys:
                df = df.orderBy(*keys)
            staged = root.at("_staging", name)
            df.write.mode("overwrite").format(fmt).save(staged)
            n = int(spark.read.format(fmt).load(staged).count())
            root.publish(name)
            if run is not None:
                root.write_text(root.at("_manifest", name), json.dumps(
                    {"run": run, "format": fmt, "rows": n, "sort_keys": asked}))
            rows.append((name, True, n, round(time.time() - t0, 3), None, path, False))
        except Exception as exc:  # one failing entry must not stop the export
            if _session_lost(spark, exc):  # but nothing can follow a lost session
                raise
            msg = f"{type(exc).__name__}: {str(exc).splitlines()[0][:300] if str(exc) else ''}"
            rows.append((name, False, None, round(time.time() - t0, 3), msg, None, False))
    return spark.createDataFrame(rows, STATUS_SCHEMA)
