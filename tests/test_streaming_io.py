"""Streaming rollup, CSV round trip and the export job."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from regiopanel.session import scratch_path
from regiopanel.sources.csv_io import read_csv, schema_of, write_csv
from regiopanel.sources.export import run_export
from regiopanel.plans.sqlfrag import code_sql
from regiopanel.streaming.rollup_stream import current, lineitem_stream_sum, publish


def test_stream_rollup_equals_batch(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").schema
    out = scratch_path(spark, "stream-out")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run resumes from the checkpoint and adds nothing
        q = publish(lineitem_stream_sum(spark, SF_SMALL, schema), out, checkpoint)
        q.awaitTermination(120)
    got = {(r.code, r.year): r.total_qty for r in current(spark, out).collect()}
    want = dict(((c, y), v) for c, y, v in duckdb.sql(
        f"SELECT {code_sql('l_suppkey')}, CAST(year(l_shipdate) AS INTEGER), SUM(l_quantity) "
        f"FROM '{SF_SMALL}/lineitem.parquet' GROUP BY 1, 2").fetchall())
    assert got == want


def test_csv_keeps_text_codes(spark):
    df = spark.createDataFrame([("00012", 2019, 1.5)], "code string, year int, v double")
    path = scratch_path(spark, "csv-test")
    write_csv(df, path)
    back = read_csv(spark, path, schema_of(df)).first()
    assert (back.code, back.year, back.v) == ("00012", 2019, 1.5)


def test_export_reports_failures_and_goes_on(spark):
    good = lambda: spark.range(3).withColumn("x", F.col("id") * 2)

    def bad():
        raise RuntimeError("boom")
    status = {r.name: r for r in run_export(spark, {"good": good, "bad": bad}, scratch_path(spark, "exp")).collect()}
    assert status["good"].ok and status["good"].row_count == 3
    assert not status["bad"].ok and "boom" in status["bad"].error


def test_saved_labels_reload_as_strings(spark):
    """A saved model result is re-read as the next stage's input; labels stay text ('Anomalo')."""
    from regiopanel.operators.cluster import attach_labels
    full = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, 9.0)], "id long, x double")
    kept = spark.createDataFrame([(1, 0), (2, 1)], "id long, cluster int")
    labelled = attach_labels(full, kept, "id", "cluster")
    path = scratch_path(spark, "labels-csv")
    write_csv(labelled, path)
    back = read_csv(spark, path, schema_of(labelled))
    assert dict(back.dtypes)["cluster"] == "string"
    assert {r.id: r.cluster for r in back.collect()} == {1: "0", 2: "1", 3: "Anomalo"}


def test_export_order_by_is_global_across_part_files(spark):
    import glob
    import pandas as pd
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.col("id").alias("v")).repartition(8)
    root = scratch_path(spark, "ordered")
    status = run_export(spark, {"t": lambda: df}, root, sort_keys={"t": ["k"]}).first()
    assert status.ok and status.row_count == 5000
    local = root.replace("file:", "")
    files = sorted(glob.glob(f"{local}/t/part-*.parquet"))
    ks = pd.concat([pd.read_parquet(f) for f in files])["k"].tolist()
    assert ks == sorted(ks)


def test_read_csv_dir_one_table_per_stem(spark):
    import pytest
    from regiopanel.sources.csv_io import read_csv_dir
    a = spark.createDataFrame([("007", 2020, 1.0)], "code string, year int, x double")
    b = spark.createDataFrame([("008", 2021)], "code string, year int")
    folder = scratch_path(spark, "dir")
    write_csv(a, f"{folder}/a.csv")
    write_csv(b, f"{folder}/b")
    schemas = {"a": schema_of(a), "b": schema_of(b)}
    got = read_csv_dir(spark, folder, schemas, out_path=folder + "-out")
    with pytest.raises(ValueError):
        read_csv_dir(spark, folder, schemas, out_path=f"{folder}/panel")
    with pytest.raises(ValueError):
        read_csv_dir(spark, folder, {"a": schemas["a"]})
    assert sorted(got) == ["a", "b"]
    assert got["a"].first().code == "007" and got["b"].first().year == 2021


def test_jdbc_options_without_a_database():
    import pytest
    from regiopanel.sources.tables import jdbc_options
    plain = jdbc_options("jdbc:x", "SELECT 1", properties={"user": "u"})
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "query": "SELECT 1"}
    split = jdbc_options("jdbc:x", "SELECT 1", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=3)
    assert split["dbtable"] == "(SELECT 1) AS q" and split["numPartitions"] == "3" and "query" not in split
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "SELECT 1", partition_column="id", lower_bound=0)


def test_export_raises_when_the_connection_is_lost(spark):
    import pytest

    def lost():
        raise ConnectionRefusedError("gone")
    with pytest.raises(ConnectionRefusedError):
        run_export(spark, {"a": lost, "b": lambda: spark.range(1)}, scratch_path(spark, "lost"))
