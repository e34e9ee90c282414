"""Sinks keep the export order; persisted scoring models score identically."""

import tempfile

from pyspark.sql import functions as F

from lendlake.operators import scoring as sc
from lendlake.plans.registry import portfolio
from lendlake.sources import sinks
from tests.conftest import SMOKE


def test_ordered_single_file_export(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"), F.col("id").alias("v")).repartition(5)
    out = tempfile.mkdtemp(prefix="lendlake-export-")
    sinks.export_csv(df, out, [F.col("k").desc()], single_file=True)
    back = sinks.read_csv(spark, out, "k long, v long").collect()
    assert [r.k for r in back] == sorted((r.k for r in df.collect()), reverse=True)


def test_saved_models_score_identically(spark):
    p = portfolio(spark, SMOKE)
    fitted = sc.fit_scoring_models(p.joined, p.cfg)
    path = tempfile.mkdtemp(prefix="lendlake-models-")
    sc.save_models(fitted, path)
    loaded = sc.load_models(path)
    ids = p.loans.select("loan_id")
    a = sc.score_batch(fitted, ids, p.joined, p.cfg)
    b = sc.score_batch(loaded, ids, p.joined, p.cfg)
    assert a.count() == ids.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    row = a.agg(F.min("probability_of_default"), F.max("probability_of_default")).first()
    assert 0.0 <= row[0] <= row[1] <= 1.0
