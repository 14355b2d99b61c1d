"""Many rows of a fit are dealt to all cores; the fit stays the same."""

import numpy as np
from pyspark.sql import functions as F

from regiopanel.operators import cluster
from regiopanel.operators.cluster import SweepModel, kmeans_sweep


def test_rows_in_one_partition_are_dealt(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 1).select("id", *[(F.hash("id", F.lit(i)) % 1000 / 100.0).alias(c) for i, c in enumerate("abc")])
    models = [SweepModel("ab", ["a", "b"], 4), SweepModel("abc", ["a", "b", "c"], 3)]
    whole = kmeans_sweep(df, "id", models, max_iter=2)
    parts = []
    plain = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *c: parts.append(n) or plain(self, n, *c))
    assert kmeans_sweep(df, "id", models, max_iter=2).keys() == whole.keys() and not parts  # few rows stay where they are
    monkeypatch.setattr(cluster, "DEALT_ROWS", 1000)
    dealt = kmeans_sweep(df, "id", models, max_iter=2)
    monkeypatch.setattr(cluster, "PART_ROWS", 50)
    kmeans_sweep(df, "id", models[:1], max_iter=1)
    assert parts == [spark.sparkContext.defaultParallelism, max(60, spark.sparkContext.defaultParallelism)]
    for key, fit in whole.items():
        assert np.allclose(fit["centres"], dealt[key]["centres"], rtol=1e-12) and np.isclose(fit["cost"], dealt[key]["cost"], rtol=1e-12)
