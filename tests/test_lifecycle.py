"""The reference's three stages end to end on the smallest tables:
export rollups -> reload with schemas -> panel -> model -> saved labels -> classifier."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from regiopanel.operators.classify import fit_logit, predict_logit, zscore_array
from regiopanel.operators.panel import merge_panel, rename_columns
from regiopanel.session import scratch_path
from regiopanel.sources.csv_io import read_csv, schema_of, write_csv
from regiopanel.sources.export import run_export


def test_extract_integrate_model(spark):
    qs = entry.queries()
    # 1. Extract: two rollups exported, one failing entry reported and skipped.
    root = scratch_path(spark, "lifecycle-export")
    builders = {"yearly_sum": lambda: qs["yearly_sum"](spark, SF_SMALL),
                "yearly_count": lambda: qs["yearly_count"](spark, SF_SMALL),
                "broken": lambda: spark.table("no_such_table")}
    status = {r.name: r for r in run_export(spark, builders, root, fmt="csv").collect()}
    assert status["yearly_sum"].ok and status["yearly_count"].ok and not status["broken"].ok
    # 2. Integrate: reload with declared schemas, rename to one vocabulary, merge.
    a = read_csv(spark, f"{root}/yearly_sum", schema_of(qs["yearly_sum"](spark, SF_SMALL)))
    b = read_csv(spark, f"{root}/yearly_count", schema_of(qs["yearly_count"](spark, SF_SMALL)))
    b = rename_columns(b.withColumnRenamed("code", "region_code"), {"region_code": "code"})
    panel = merge_panel({"a": a, "b": b})
    assert panel.count() == b.count()  # every yearly_sum key is also a yearly_count key
    assert dict(panel.dtypes)["code"] == "string"
    # 3. Model: cluster labels with anomalies excluded, saved, reloaded, classified.
    labels = qs["exclude_refit_label"](spark, SF_SMALL)
    path = scratch_path(spark, "lifecycle-labels")
    write_csv(labels, path)
    saved = read_csv(spark, path, schema_of(labels))
    assert dict(saved.dtypes)["cluster_label"] == "string"
    flagged = saved.filter(F.col("is_anomalous") == 1)
    assert flagged.filter(F.col("cluster_label") != "Anomalo").count() == 0
    feats = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("user_id").agg(
        F.array(F.count(F.lit(1)).cast("double"), F.avg("value")).alias("f"))
    xy = zscore_array(feats, "f").join(saved.select("user_id", F.col("cluster_label").alias("y")), "user_id")
    model, classes = fit_logit(xy, "f", "y", max_iter=100)
    assert classes == sorted(classes)
    pred = predict_logit(xy, model, classes, "f")
    assert pred.count() == xy.count()


def test_panel_chain_needs_a_null_policy(spark):
    import pytest
    from regiopanel.operators.cluster import kmeans_labels
    from regiopanel.operators.panel import resolve_nulls
    from regiopanel.operators.stats import zscore
    panel = entry.queries()["panel_full_outer"](spark, SF_SMALL)
    measures = [c for c, t in panel.dtypes if c not in ("code", "year")]
    with pytest.raises(ValueError):
        resolve_nulls(panel, measures, "guess")
    whole = resolve_nulls(panel, measures, "drop")
    filled = resolve_nulls(panel, measures, "fill", 0.0)
    assert filled.count() == panel.count() > whole.count()
    assert filled.filter(" OR ".join(f"{c} IS NULL" for c in measures)).count() == 0
    keyed = filled.withColumn("key", F.concat_ws("|", "code", "year"))
    labels, centres, _ = kmeans_labels(zscore(keyed, measures), measures, k=3, order_col="key")
    assert labels.groupBy("cluster").count().count() == 3 and centres.shape == (3, len(measures))
