"""Spark session construction and shared-storage helpers.

Library code never builds its own session: every operator takes DataFrames
(and, where it must write, reads ``spark.checkpoint.dir`` from the session).
``build_session`` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

LOCAL_CHECKPOINT_FALLBACK = "/tmp/regiopanel-checkpoints"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "regiopanel") -> SparkSession:
    """Session for local runs. On a cluster, the submit config wins."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoints (ranks, forest scores) are removed once their DataFrames are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` is used as given. Only when it is
    unset (local tests) do we set one of our own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder would lose checkpoints with the executor.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        current = LOCAL_CHECKPOINT_FALLBACK
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run on executors are pickled by reference, so workers must
    be able to import the package; Spark serves the archive to each executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_regiopanel_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="regiopanel-"), "regiopanel.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._regiopanel_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/regiopanel/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the entries of a folder, on whatever file system holds it."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named; any other path is refused."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/regiopanel/"
    if not path.startswith(base) or ".." in path:
        raise ValueError(f"not a scratch folder: {path}")
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and return a DataFrame reading it.

    Cuts lineage for results that are read several times (ranks, forest
    scores, an aggregated panel) so their inputs are scanned once, and a lost
    executor does not force recomputation. Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
