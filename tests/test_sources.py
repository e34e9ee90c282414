"""Sources and typed loads on raw text input."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendlake.config import PortfolioConfig
from lendlake.operators import profiling as pf
from lendlake.sources import sinks, staging


def raw_loans(spark):
    rows = [("L1", "2020-03-01", "1", "12.345"), ("L2", "2021-01-31", "0", None), ("L3", None, None, "-7")]
    return spark.createDataFrame(rows, "loan_id string, received_date string, is_loss string, loss_amount string")


def test_text_loans_are_typed(spark):
    out = {r.loan_id: r for r in staging.stage_loans(raw_loans(spark)).collect()}
    assert (out["L1"].received_date, out["L1"].is_loss, out["L1"].loss_amount) == (date(2020, 3, 1), True, Decimal("12.35"))
    assert (out["L2"].is_loss, out["L2"].loss_amount) == (False, None)
    assert (out["L3"].received_date, out["L3"].is_loss, out["L3"].loss_amount) == (None, None, Decimal("-7.00"))


def test_bad_text_fails_the_load_and_is_counted(spark):
    bad = raw_loans(spark).unionByName(
        spark.createDataFrame([("L4", "first of May", "maybe", "12,5")], raw_loans(spark).schema)
    )
    counts = {r.column_name: r.failed_casts for r in staging.cast_failures(
        bad, {"received_date": "DATE", "is_loss": "BOOLEAN", "loss_amount": "DECIMAL(12,2)"}).collect()}
    assert counts == {"received_date": 1, "is_loss": 1, "loss_amount": 1}
    with pytest.raises(Exception):
        staging.stage_loans(bad).collect()


def test_features_given_as_text(spark):
    cfg = PortfolioConfig(categorical=["c", "b"], string_features=["c"], boolean_features=["b"])
    raw = spark.createDataFrame([("L1", "7", "0", "1.5", "3")], "loan_id string, c string, b string, x string, y string")
    row = staging.stage_features(raw, cfg).first()
    assert (row.c, row.b, row.x, row.y) == ("7", False, 1.5, 3.0)


def test_sources_views_read_back_and_sample(spark, tmp_path):
    loans = staging.stage_loans(raw_loans(spark))
    staging.register_sources(spark, {"raw_loans_under_test": loans})
    assert spark.table("raw_loans_under_test").count() == 3
    stored = sinks.write_table(loans, f"file://{tmp_path}/loans")
    assert stored.count() == 3
    assert [r.loan_id for r in staging.read_back(spark, f"file://{tmp_path}/loans", "loss_amount < 0").collect()] == ["L3"]
    assert staging.scan(spark, f"file://{tmp_path}/loans").count() == 3
    sinks.publish_view(stored, "loans_view_under_test")
    assert pf.sample_rows(spark.table("loans_view_under_test"), 2).count() == 2


def test_staging_joins_only_ids_that_repeat_or_are_missing(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from lendlake.plans import registry

    def write(folder, orders):
        lines = [(k, q, 10.0 * q, 0.08, 0.01, "R", "F") for k, q in ((1, 2.0), (1, 3.0), (2, 4.0))]
        rows = [(k, c, "F", 5.0 + c, datetime(1999, 1, c + 1), "2-HIGH") for k, c in orders]
        spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
        spark.createDataFrame(lines, "l_orderkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
        spark.createDataFrame([(0, 250.0, "A"), (1, -3.0, "B")], "c_custkey bigint, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
        return str(folder)

    joins, join = [], registry.join_loans
    monkeypatch.setattr(registry, "join_loans", lambda *a: joins.append(1) or join(*a))
    for name, orders, joined, rows in (("once", [(1, 0), (2, 1), (3, 2)], 0, 3), ("odd", [(1, 0), (1, 1), (2, 2), (None, 0), (None, 1)], 1, 7)):
        folder = write(tmp_path / name, orders)
        joins.clear()
        p = registry.Portfolio(spark, folder)
        assert len(joins) == joined
        plain = registry.Portfolio(spark, folder, materialize=False)
        every = p.loans.join(p.features.withColumnRenamed("loan_id", "id"), F.col("loan_id") == F.col("id"), "left").drop("id")
        for stored, lazy in ((p.loans, plain.loans), (p.features, plain.features), (p.joined, every)):
            assert stored.columns == lazy.columns and sorted(map(str, stored.collect())) == sorted(map(str, lazy.collect()))
        assert p.joined.count() == rows
