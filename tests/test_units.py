"""Hand-made edge cases (ties, medians, windows, bands, sentinels, NULL levels)."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lendlake.config import SEVERITY_BANDS, PortfolioConfig, Sentinel
from lendlake.functions import band_label, band_order, decimal_median, sentinel_flag, sentinel_to_null
from lendlake.operators import features as fx
from lendlake.operators import marts, metrics, quality, ranking

LOAN_SCHEMA = "loan_id string, received_date date, is_loss boolean, loss_amount decimal(12,2)"


def loans(spark, rows):
    return spark.createDataFrame(rows, LOAN_SCHEMA)


def test_ties_rank_by_id_rows_frame(spark):
    df = loans(spark, [("c", date(2020, 1, 1), True, D("5.00")), ("a", date(2020, 1, 1), True, D("5.00")),
                       ("b", date(2020, 1, 1), True, D("5.00")), ("d", date(2020, 1, 1), True, D("9.00"))])
    for method in ("plain", "scaled"):
        out = ranking.loss_concentration(df, method=method, buckets=2).orderBy("loss_rank").collect()
        assert [r.loan_id for r in out] == ["d", "a", "b", "c"]
        assert [float(r.cumulative_positive_loss_amount) for r in out] == [9.0, 14.0, 19.0, 24.0]
        assert out[-1].cumulative_positive_loss_share == 1.0


def test_scaled_rank_equals_plain_with_hot_amount(spark):
    # One amount holds a third of the rows; cut points include the id, so the
    # hot value is spread over several buckets and the result is unchanged.
    rows = [(f"L{i:05d}", date(2020, 1, 1), True, D("100.00") if i % 3 == 0 else D(i % 97 + 1)) for i in range(3000)]
    df = loans(spark, rows).repartition(7)
    plain = ranking.loss_concentration(df, method="plain").select("loan_id", "loss_rank", "cumulative_positive_loss_amount")
    scaled = ranking.loss_concentration(df, method="scaled", buckets=16).select("loan_id", "loss_rank", "cumulative_positive_loss_amount")
    assert plain.exceptAll(scaled).count() == 0 and scaled.exceptAll(plain).count() == 0


def test_ranges_split_a_hot_value_and_place_nulls(spark):
    # The order includes the id, so the hot amount is spread over ranges; NULL keys sort as in the plain form.
    rows = [(None if i % 5 == 0 else 7, f"L{i:04d}") for i in range(400)]
    df = spark.createDataFrame(rows, "x int, id string")
    for order in ([("x", True), ("id", False)], [("x", False), ("id", True)]):
        plain = ranking.running_totals(df, order, {"s": "x"}, rank_col="r", method="plain")
        scaled = ranking.running_totals(df, order, {"s": "x"}, rank_col="r", buckets=8)
        assert plain.exceptAll(scaled).count() == 0 and scaled.exceptAll(plain).count() == 0
    ranges = df.repartitionByRange(8, F.col("x").desc(), "id").groupBy(F.spark_partition_id()).count()
    assert ranges.agg(F.max("count")).first()[0] < 320


def test_scaled_rank_invariant_to_partitioning(spark):
    rows = [(f"L{i}", date(2020, 1, 1), True, D(i % 13 + 1)) for i in range(200)]
    a = ranking.loss_concentration(loans(spark, rows).coalesce(1), buckets=4).select("loan_id", "loss_rank")
    b = ranking.loss_concentration(loans(spark, rows).repartition(23), buckets=8).select("loan_id", "loss_rank")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize(
    "values,expected",
    [(["1.00", "1.01"], "1.00"), (["-1.01", "-1.02"], "-1.01"), (["1.00", "2.00", "4.00"], "2.00"), (["0.01", "0.02"], "0.01")],
)
def test_decimal_median_truncates_midpoint(spark, values, expected):
    df = spark.createDataFrame([(D(v),) for v in values], "x decimal(12,2)")
    assert df.agg(decimal_median("x")).first()[0] == D(expected)


def test_empty_positive_population(spark):
    df = loans(spark, [("a", date(2020, 1, 1), True, D("0.00")), ("b", date(2020, 1, 2), False, None),
                       ("c", date(2020, 1, 3), True, D("-3.00"))])
    seg = marts.risk_segmentation(df.withColumn("feat_001", F.lit("x")), PortfolioConfig(categorical=["feat_001"]))
    assert seg.first().portfolio_positive_loss_share is None
    conc = ranking.loss_concentration(df)
    assert conc.count() == 0
    assert quality.curve_reaches_one(conc).first().passed is False
    assert quality.band_shares_sum_to_one(marts.severity_bands(df)).first().passed is False
    assert ranking.concentration_summary(conc).count() == 0


def test_window_edges_half_open(spark):
    rows = [("a", date(2024, 6, 30), True, None), ("b", date(2023, 6, 30), True, None),  # anchor - 12m: prior
            ("c", date(2023, 7, 1), False, None), ("d", date(2022, 6, 30), True, None),   # anchor - 24m: neither
            ("e", None, True, None)]
    r = marts.trailing_windows(loans(spark, rows)).first()
    assert r.funded_loan_count_last_12_months == 2
    assert r.funded_loan_count_prior_12_months == 1
    assert r.loss_rate_prior_12_months == 1.0 and r.loss_rate_last_12_months == 0.5


def test_feb_29_anchor(spark):
    b = marts.trailing_bounds(loans(spark, [("a", date(2024, 2, 29), True, None)])).first()
    assert b.last_window_start == date(2023, 2, 28) and b.prior_window_start == date(2022, 2, 28)


def test_band_borders(spark):
    df = spark.createDataFrame([(D(v),) for v in ["9999.99", "10000", "25000", "100000", "0.01"]], "x decimal(12,2)")
    out = df.select(band_order("x", SEVERITY_BANDS).alias("o"), band_label("x", SEVERITY_BANDS).alias("l")).collect()
    assert [(r.o, r.l) for r in out] == [(1, "$0-10k"), (2, "$10k-25k"), (3, "$25k-50k"), (5, "$100k+"), (1, "$0-10k")]


def test_sentinel_border(spark):
    df = spark.createDataFrame([(994.99,), (995.0,), (None,), (float("nan"),)], "x double")
    out = df.select(sentinel_to_null("x", 995).alias("v"), sentinel_flag("x", 995).alias("f")).collect()
    assert out[0].v == 994.99 and out[0].f == 0
    assert out[1].v is None and out[1].f == 1
    assert out[2].v is None and out[2].f == 0  # native NULL is not a code
    assert out[3].v is None and out[3].f == 1  # NaN >= 995 is true in Spark


def test_null_category_segment_and_other(spark):
    cfg = PortfolioConfig(categorical=["feat_001"], sentinels=[Sentinel("s", 995)], train_cutoff="2021-01-01")
    rows = [("a", date(2020, 1, 1), True, D("1.00"), None, 1.0), ("b", date(2022, 1, 1), False, D("0.00"), None, 999.0)]
    df = spark.createDataFrame(rows, LOAN_SCHEMA + ", feat_001 string, s double")
    seg = marts.risk_segmentation(df, cfg).collect()
    assert {r.segment for r in seg} == {"__NULL__"}
    ts = fx.training_set(df, cfg).orderBy("loan_id").collect()
    assert [r.feat_001_grouped for r in ts] == ["OTHER", "OTHER"]
    assert [r.is_unobserved_s for r in ts] == [0, 1] and ts[1].s is None


def test_duplicate_vectors_nulls_equal(spark):
    rows = [("a", date(2020, 1, 1), True, D("1"), None, 1.0), ("b", date(2020, 1, 1), True, D("1"), None, 1.0),
            ("c", date(2020, 1, 1), True, D("1"), "x", 1.0)]
    df = spark.createDataFrame(rows, LOAN_SCHEMA + ", f1 string, f2 double")
    r = marts.duplicate_vectors(df).first()
    assert (r.duplicate_feature_vector_groups, r.duplicate_feature_vector_loan_count, r.distinct_feature_vector_count) == (1, 2, 2)


def test_score_ties_auc_ap(spark):
    df = spark.createDataFrame(list(zip([0.9, 0.8, 0.7, 0.7, 0.3, 0.2], [1, 0, 1, 0, 0, 1])), "score double, y int")
    for method in ("plain", "scaled"):
        assert metrics.roc_auc(df, "score", "y", method).first()[0] == pytest.approx(0.5)
        assert metrics.average_precision(df, "score", "y", method).first()[0] == pytest.approx(0.6667, abs=1e-4)


def test_risk_decile_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 21)], "score double")
    d = metrics.with_risk_decile(df, "score").orderBy("score").collect()
    assert d[0].risk_decile == 10 and d[-1].risk_decile == 1
    assert sorted({r.risk_decile for r in d}) == list(range(1, 11))


def test_checks_runner_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (2, None)], "k int, v string")
    checks = [quality.Check("unique", "t", "k"), quality.Check("not_null", "t", "k"),
              quality.Check("accepted_values", "t", "v", values=["a", "b"]),
              quality.Check("expression", "t", expression="k > 1", where="v is not null")]
    out = {r.check_kind: r.n_violations for r in quality.run_checks({"t": df}, checks).collect()}
    assert out == {"unique": 1, "not_null": 1, "accepted_values": 1, "expression": 2}


def test_exact_quantiles_hot_value_and_groups(spark):
    from lendlake.operators.quantiles import exact_median, exact_quantiles

    # One value holds a third of group "a" and sits on its median.
    rows = [("a", 50.0)] * 1000 + [("a", float(i)) for i in range(2000)] + [("b", float(i % 7)) for i in range(301)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.1, 0.5, 0.9, 1.0]
    got = {r.k: r.quantiles for r in exact_quantiles(df, ["k"], "x", probs).collect()}
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("x", probs).alias("q")).collect()}
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)
    dec = spark.createDataFrame([(D("1.00"),), (D("1.01"),), (D("-5.00"),), (D("7.00"),)], "x decimal(12,2)")
    assert exact_median(dec, [], "x").first()[0] == D("1.00")


def test_rank_metrics_by_group_match_single(spark):
    rows = list(zip([0.9, 0.8, 0.7, 0.7, 0.3, 0.2], [1, 0, 1, 0, 0, 1]))
    df = spark.createDataFrame([("a", s, y) for s, y in rows] + [("b", 1 - s, y) for s, y in rows], "g string, score double, y int")
    got = {r.g: r.roc_auc for r in metrics.rank_metrics_by_group(df, "g", "score", "y").collect()}
    for g in ("a", "b"):
        want = metrics.roc_auc(df.where(F.col("g") == g), "score", "y").first()[0]
        assert got[g] == pytest.approx(want)
    assert got["a"] == pytest.approx(0.5)


def test_auc_of_large_counts_does_not_overflow(spark):
    # 4e9 rows a side cannot be made here; the totals are what overflowed.
    counts = spark.createDataFrame([(0.1, 0, 4_000_000_000), (0.9, 4_000_000_000, 0)], "s double, pos bigint, neg bigint")
    P, N = metrics._totals(counts)
    assert counts.select((P * N).alias("x")).first()[0] == 1.6e19


def test_deciles_drop_equal_edges_and_keep_close_scores_apart(spark):
    import numpy as np
    import pandas as pd

    for xs in ([0.1 * (i % 5) if i % 3 else 0.5 for i in range(60)], [1e-8 * i for i in range(100)], [0.5] * 7):
        df = spark.createDataFrame([(float(x),) for x in xs], "s double")
        got = sorted((r.s, r.risk_decile) for r in metrics.with_risk_decile(df, "s").collect())
        labels = pd.qcut(pd.Series(sorted(xs)), 10, labels=False, duplicates="drop")
        want = [10 - (0 if np.isnan(b) else int(b)) for b in labels]
        assert [d for _, d in got] == want


def test_checks_fail_on_empty_and_one_sided_input(spark):
    from lendlake.operators import quality as dq

    one_side = spark.createDataFrame([("test", date(2020, 1, 1))], "split string, received_date date")
    assert not dq.split_is_chronological(one_side).first().passed
    seg = spark.createDataFrame([], "feature_name string, portfolio_loan_share double, portfolio_positive_loss_share double")
    assert [r.passed for r in dq.shares_sum_to_one(seg).collect()] == [False]
    assert not dq.no_group_straddles_split(spark.createDataFrame([], "split string, a int"), ["a"]).first().passed


def test_staging_folders_of_similar_names_stay_apart(spark):
    from lendlake.plans.registry import staging_folder

    assert staging_folder(spark, "/data/a_b") != staging_folder(spark, "/data/a/b")
    assert "data" not in staging_folder(spark, "hdfs://host/data")


def test_shared_folder_is_required_off_local_masters():
    from types import SimpleNamespace

    from lendlake.session import checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]")
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)


def test_levels_grouped_by_broadcast_and_by_salted_join(spark, monkeypatch):
    from lendlake.operators import features as fx

    rows = [(i, "hot" if i % 3 else f"r{i}", "train") for i in range(200)] + [(900, "hot", "test"), (901, None, "test")]
    df = spark.createDataFrame(rows, "id int, c string, split string")
    a = {r.id: r.c_grouped for r in fx.with_grouped_level(df, "c", 50, "OTHER").collect()}
    monkeypatch.setattr(fx, "MAX_BROADCAST_LEVELS", 0)
    b = {r.id: r.c_grouped for r in fx.with_grouped_level(df, "c", 50, "OTHER").collect()}
    assert a == b and len(a) == 202 and a[900] == "hot" and a[901] == "OTHER" and a[0] == "OTHER"


def test_quantiles_leave_out_nan_and_report_it(spark):
    from lendlake.operators.quantiles import exact_quantiles, nan_count

    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(df, [], "x", [0.5], "q").first().q == [1.5]
    assert nan_count(df, [], "x").first().nan_count == 1


@pytest.mark.parametrize("small,miss", [(20_000, False), (5, False), (5, True), (20_000, True)])
def test_quantiles_by_repeated_selection(spark, monkeypatch, small, miss):
    """Brackets that hold too many values, or miss their ranks altogether, are narrowed to the exact result."""
    import numpy as np
    from lendlake.operators import quantiles as qt

    monkeypatch.setattr(qt, "SMALL_BRACKET", small)
    monkeypatch.setattr(qt, "GRID", 7)
    rng = np.random.default_rng(2)
    rows = [(g, float(x)) for g, n in (("a", 900), ("b", 7), ("c", 1)) for x in np.round(rng.normal(size=n), 2)]
    rows += [("a", 0.5)] * 400 + [("d", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    if miss:  # a sketch that points at the wrong place
        whole = qt.F.percentile_approx
        monkeypatch.setattr(qt, "DEFAULT_ACCURACY", 10_000)

        def wrong(col, percentage, accuracy=10_000):
            found = whole(col, percentage, accuracy)
            return found if len(percentage) == 7 else qt.F.transform(found, lambda e: e + 0.4)

        monkeypatch.setattr(qt.F, "percentile_approx", wrong)
    for keys in (["g"], []):
        got = {tuple(r[k] for k in keys): r["q"] for r in qt.exact_quantiles(df, keys, "x", probs, "q").collect()}
        groups = ["a", "b", "c"] if keys else [None]
        for name in groups:
            x = [v for g, v in rows if v is not None and v == v and name in (None, g)]
            assert got[(name,) if keys else ()] == pytest.approx(np.quantile(x, probs).tolist(), abs=1e-12)
        assert len(got) == len(groups)
