"""The export keeps old results when an entry fails and goes on where a run of the same name stopped."""

import pytest
from pyspark.sql import functions as F

from regiopanel.session import file_system, scratch_path
from regiopanel.sources.export import _Root, run_export


def _fails_half_way(spark):
    """A result whose job dies after some of its tasks have written."""
    x = spark.range(0, 1000, 1, 4)
    return x.withColumn("v", F.when(F.col("id") == 900, F.raise_error(F.lit("half way"))).otherwise(F.col("id")))


def _rows(status):
    return {r.name: r for r in status.collect()}


def test_failed_overwrite_keeps_the_old_result(spark):
    root = scratch_path(spark, "resume")
    assert _rows(run_export(spark, {"a": lambda: spark.range(5)}, root))["a"].row_count == 5
    status = _rows(run_export(spark, {"a": lambda: _fails_half_way(spark), "b": lambda: spark.range(2)}, root))
    assert not status["a"].ok and "half way" in status["a"].error and status["b"].ok
    assert sorted(r.id for r in spark.read.parquet(f"{root}/a").collect()) == list(range(5))


def test_second_run_builds_only_what_is_missing(spark):
    root, built, broken = scratch_path(spark, "resume"), [], [True]

    def entry(name, n):
        def build():
            built.append(name)
            return _fails_half_way(spark) if name == "b" and broken[0] else spark.range(n)
        return build
    builders = {n: entry(n, k) for n, k in (("a", 3), ("b", 4), ("c", 5))}
    first = _rows(run_export(spark, builders, root, run="2024-01"))
    assert [first[n].ok for n in "abc"] == [True, False, True]
    broken[0] = False
    built.clear()
    second = _rows(run_export(spark, builders, root, run="2024-01"))
    assert built == ["b"] and all(r.ok for r in second.values())
    assert [(second[n].skipped, second[n].row_count) for n in "abc"] == [(True, 3), (False, 4), (True, 5)]
    # Another name, other keys or another format is another run; no name builds everything.
    for more in ({"run": "2024-02"}, {"run": "2024-02", "sort_keys": {n: ["id"] for n in "abc"}}, {}, {"run": "2024-02"}):
        built.clear()
        assert not any(r.skipped for r in run_export(spark, builders, root, **more).collect())
        assert built == ["a", "b", "c"]


def test_failure_under_a_new_name_is_not_finished(spark):
    root = scratch_path(spark, "resume")
    run_export(spark, {"a": lambda: spark.range(3)}, root, run="one")
    assert not run_export(spark, {"a": lambda: _fails_half_way(spark)}, root, run="two").first().ok
    # The old result still stands as run one's.
    assert run_export(spark, {"a": lambda: spark.range(9)}, root, run="one").first().skipped
    again = run_export(spark, {"a": lambda: spark.range(9)}, root, run="two").first()
    assert not again.skipped and again.row_count == 9 and spark.read.parquet(f"{root}/a").count() == 9


def test_lost_between_the_renames(spark):
    """The old result was moved aside and the driver died: the next run puts it back, then works as ever."""
    root = scratch_path(spark, "resume")
    run_export(spark, {"a": lambda: spark.range(3)}, root, run="one")
    folders = _Root(spark, root)
    folders.move(f"{root}/a", f"{root}/_replaced/a")
    spark.range(7).write.parquet(f"{root}/_staging/a")
    assert not run_export(spark, {"a": lambda: _fails_half_way(spark)}, root, run="two").first().ok
    assert spark.read.parquet(f"{root}/a").count() == 3
    folders.move(f"{root}/a", f"{root}/_replaced/a")
    assert run_export(spark, {"a": lambda: spark.range(8)}, root, run="two").first().row_count == 8
    assert spark.read.parquet(f"{root}/a").count() == 8 and not folders.exists(f"{root}/_replaced/a")


def test_lost_result_is_written_again(spark):
    root = scratch_path(spark, "resume")
    run_export(spark, {"a": lambda: spark.range(3)}, root, run="one")
    fs, p = file_system(spark, f"{root}/a")
    fs.delete(p, True)
    assert not run_export(spark, {"a": lambda: spark.range(3)}, root, run="one").first().skipped


def test_sorted_and_empty_results_and_names(spark):
    root = scratch_path(spark, "resume")
    keys = {"e": ["id"]}
    for skipped in (False, True):
        got = run_export(spark, {"e": lambda: spark.range(0)}, root, fmt="csv", sort_keys=keys, run="r").first()
        assert (got.ok, got.skipped, got.row_count) == (True, skipped, 0)
    for name in ("_manifest", ".x", "a/b", ""):
        with pytest.raises(ValueError):
            run_export(spark, {name: lambda: spark.range(1)}, root)
