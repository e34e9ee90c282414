"""Closed-form checks of the model layer (penalty mappings, preparation)."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lendlake.operators import models as ml
from lendlake.operators.pipeline import Ridge


def test_preprocessor_exact_median_population_std_unknown_level(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a"), (4.0, None)], "x double, c string")
    pre = ml.fit_preprocessor(train, ["c"], ["x"])
    assert pre.medians["x"] == 2.5  # Spark's Imputer would give 2.0
    assert pre.scales["x"] == pytest.approx(np.std([1, 2, 3, 4]))  # population std
    test = spark.createDataFrame([(None, "zzz"), (2.5, None)], "x double, c string")
    vecs = [r.features.toArray() for r in pre.transform(test).collect()]
    # x imputed with the median -> 0 after scaling; unseen level -> all zeros
    assert vecs[0][0] == pytest.approx(0.0) and vecs[0][1:].sum() == 0
    # NULL category is imputed to MISSING, a level seen in training
    assert vecs[1][1:].sum() == 1


def test_route_columns_rejects_unclaimed(spark):
    from lendlake.operators.features import route_columns

    df = spark.createDataFrame([(1, "a", [1])], "n int, s string, arr array<int>")
    with pytest.raises(ValueError):
        route_columns(df, [])
    assert route_columns(df.drop("arr"), []) == (["s"], ["n"])


def test_class_weights_balanced(spark):
    from lendlake.operators.features import class_weights

    df = spark.createDataFrame([(True,)] * 2 + [(False,)] * 6, "y boolean")
    w = {r.y: r.class_weight for r in class_weights(df, "y").collect()}
    assert w[True] == pytest.approx(8 / (2 * 2)) and w[False] == pytest.approx(8 / (2 * 6))


def test_levels_without_a_limit(spark, monkeypatch):
    """50,000 levels encode exactly, by broadcast and by the salted join, and no label list reaches the driver."""
    from lendlake.operators import features as fx

    train = spark.range(50_000).select(F.format_string("v%05d", F.col("id")).alias("c"), F.col("id").cast("double").alias("x"))
    pre = ml.fit_preprocessor(train, ["c"], ["x"])
    asked = spark.createDataFrame([("v00000", 0.0), ("v49999", 1.0), ("new", 2.0), (None, 3.0)], "c string, x double")
    found = {}
    for limit in (fx.MAX_BROADCAST_LEVELS, 10):
        monkeypatch.setattr(fx, "MAX_BROADCAST_LEVELS", limit)
        rows = {r["x"]: r["features"] for r in pre.pipeline.transform(asked.withColumn("keep", F.col("x"))).select(F.col("keep").alias("x"), "features").collect()}
        assert rows[0.0].size == 50_001
        marks = {x: [int(i) for i in v.indices if i > 0] for x, v in rows.items()}
        assert marks == {0.0: [1], 1.0: [50_000], 2.0: [], 3.0: []}
        found[limit] = marks
    assert len(found) == 2


def test_rare_levels_share_one_place_in_the_pipeline(spark, tmp_path):
    rows = [("a",)] * 5 + [("b",)] * 4 + [("c",), (None,), ("d",)]
    train = spark.createDataFrame(rows, "c string").withColumn("x", F.lit(1.0)).withColumn("label", F.length(F.coalesce("c", F.lit(""))) * 1.0)
    pre = ml.fit_preprocessor(train, ["c"], ["x"], group_rare=True, rare_min_count=4)
    assert pre.feature_names == ["x", "c=RARE", "c=a", "c=b"]
    pipeline = pre.then(Ridge(alpha=2.0).fit(pre.transform(train)))
    path = str(tmp_path / "pipeline")
    pipeline.save(path)
    asked = spark.createDataFrame([("a",), ("d",), ("zz",), (None,)], "c string").withColumn("x", F.lit(None).cast("double"))
    scored = [m.transform(asked).select("c", "x", "prediction").orderBy("c").collect() for m in (pipeline, PipelineModel.load(path))]
    assert scored[0] == scored[1] and len({r["prediction"] for r in scored[0]}) == 2
    assert all(r["x"] == 0.0 for r in scored[0])
