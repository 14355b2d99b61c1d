"""CSV sources and sinks with explicit schemas (codes stay text, years stay int)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from regiopanel.session import list_folder


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header row, no index; one part file per partition (no coalesce to one task)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read with a declared schema: no inference pass, codes keep leading zeros."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def read_csv_dir(spark: SparkSession, folder: str, schemas: Mapping[str, StructType | str],
                 out_path: str | None = None) -> dict[str, DataFrame]:
    """One table per entry of ``folder`` (``name.csv`` file or folder), keyed by its stem.

    A stem without a declared schema raises, so nothing is read by guess. A
    written panel must not be re-read as a source: an ``out_path`` inside
    ``folder`` is refused.
    """
    root = folder.rstrip("/")
    if out_path is not None and (out_path.rstrip("/") + "/").startswith(root + "/"):
        raise ValueError(f"output {out_path} lies in the input folder {folder}")
    found = {}
    for path in list_folder(spark, root):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if not name.startswith(("_", ".")):
            found[name.removesuffix(".csv")] = path
    unknown = sorted(set(found) - set(schemas))
    if unknown:
        raise ValueError(f"no schema for {unknown}")
    return {name: read_csv(spark, path, schemas[name]) for name, path in found.items()}


def schema_of(df: DataFrame) -> str:
    """DDL string of a DataFrame's schema, usable as the read schema of its CSV."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
