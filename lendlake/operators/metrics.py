"""Evaluation metrics and portfolio reports.

Rank metrics work on the distinct scores: one grouped count of positives and
negatives per score (partial aggregation, so a score shared by a third of
all rows is one row per task), then exact prefix sums over the distinct
scores with the bucketed running total of ``ranking.running_totals``.
Nothing is collected; no single task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlake.operators.quantiles import exact_quantiles
from lendlake.operators.ranking import running_totals


# Fixed value: from this many parameters a row, BIC is not to be trusted.
PARAMS_PER_ROW_LIMIT = 0.8


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    lab = F.col(label).cast("int")
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score).agg(
        F.sum(lab).cast("bigint").alias("pos"), F.sum(1 - lab).cast("bigint").alias("neg")
    )


def _totals(counts: DataFrame):
    t = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    packed = t.select(F.struct("P", "N").alias("t")).scalar()
    # As doubles: the product of two large counts does not fit a bigint.
    return packed["P"].cast("double"), packed["N"].cast("double")


def roc_auc(df: DataFrame, score: str, label: str, method: str = "scaled") -> DataFrame:
    """ROC-AUC by ranks, ties count one half (Mann-Whitney); NULL if a class is absent."""
    counts = _score_counts(df, score, label)
    asc = running_totals(counts, [(score, False)], {"neg_below": "neg"}, method=method, include_current=False)
    P, N = _totals(counts)
    contrib = F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)
    return asc.agg(F.sum(contrib).alias("s")).select(F.try_divide(F.col("s"), P * N).alias("roc_auc"))


def curve_points(df: DataFrame, score: str, label: str, method: str = "scaled") -> DataFrame:
    """E5: one ROC / precision-recall point per distinct score (threshold = score, >=)."""
    counts = _score_counts(df, score, label)
    desc = running_totals(counts, [(score, True)], {"tp": "pos", "fp": "neg"}, method=method)
    P, N = _totals(counts)
    return desc.select(
        F.col(score).alias("threshold"),
        "tp",
        "fp",
        F.try_divide(F.col("tp"), P).alias("tpr"),
        F.try_divide(F.col("fp"), N).alias("fpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), P).alias("recall"),
    )


def average_precision(df: DataFrame, score: str, label: str, method: str = "scaled") -> DataFrame:
    """Step-wise average precision  sum_k (R_k - R_{k-1}) * P_k  over distinct thresholds."""
    counts = _score_counts(df, score, label)
    desc = running_totals(counts, [(score, True)], {"tp": "pos", "fp": "neg"}, method=method)
    P, _ = _totals(counts)
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return desc.agg(F.sum(step).alias("s")).select(F.try_divide(F.col("s"), P).alias("average_precision"))


def threshold_metrics(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on an empty denominator), one row or one per group of ``by``."""
    p, y = F.col(pred).cast("int"), F.col(label).cast("int")
    one = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((p == 0) & (y == 1), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((p == 0) & (y == 0), 1).otherwise(0)).alias("tn"),
    )

    def safe(num, den):
        return F.coalesce(num.cast("double") / F.when(den != 0, den), F.lit(0.0))

    prec = safe(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe(F.col("tp"), F.col("tp") + F.col("fn"))
    return one.select(
        *by,
        safe(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.coalesce(2 * prec * rec / F.when(prec + rec != 0, prec + rec), F.lit(0.0)).alias("f1_score"),
    )


def confusion(df: DataFrame, pred: str, label: str) -> DataFrame:
    """The four cells, always present."""
    p, y = F.col(pred).cast("int"), F.col(label).cast("int")
    one = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").cast("bigint").alias("loans"))
        for a in (0, 1)
        for b in (0, 1)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def with_risk_decile(df: DataFrame, score: str, out: str = "risk_decile", k: int = 10) -> DataFrame:
    """Decile by quantile edges, 1 = riskiest; right-closed bins (not ``ntile``).

    The edges are the k + 1 quantiles from minimum to maximum, equal ones
    once.  The bins between them are numbered from the lowest, 0, and bin b is
    decile k - b: the lowest bin is always decile k, and with tied edges the
    highest bin has a number above 1.  A NULL score has no decile.
    """
    edges = exact_quantiles(df, [], score, [i / k for i in range(k + 1)], "e").scalar()
    s = F.col(score).cast("double")
    counted = [(s > edges[0])] + [(s > edges[i]) & (edges[i] > edges[i - 1]) for i in range(1, k + 1)]
    below = sum(c.cast("int") for c in counted)
    return df.withColumn(out, F.when(s.isNotNull(), F.lit(k) - F.greatest(below - 1, F.lit(0))).cast("int"))


def decile_table(df: DataFrame, decile: str, label: str) -> DataFrame:
    """Observed loss rate per decile, and its lead over the last decile in points.

    Sorted from the riskiest decile; the first row's lead is the spread
    between top and bottom.
    """
    rates = df.groupBy(decile).agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum(F.col(label).cast("int")).cast("bigint").alias("losses"),
        (F.sum(F.col(label).cast("int")) / F.count(F.col(label))).alias("loss_rate"),
    )
    last = rates.agg(F.max_by("loss_rate", decile)).scalar()
    return rates.withColumn("lead_over_last_pp", (F.col("loss_rate") - last) * 100).orderBy(decile)


def decline_table(df: DataFrame, score: str, label: str, shares: Sequence[float]) -> DataFrame:
    """Decline the riskiest share of loans; what is caught and what is lost.

    Cutoff = quantile(score, 1 - share); declined = score >= cutoff.  All
    shares are answered by one quantile aggregate and one conditional pass.
    """
    qs = [1 - s for s in shares]
    edges = exact_quantiles(df, [], score, qs, "e").scalar()
    s = F.col(score).cast("double")
    y = F.col(label).cast("int")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("P")]
    for i in range(len(shares)):
        dec = s >= edges[i]
        aggs += [
            edges[i].alias(f"cut{i}"),
            F.count_if(dec).alias(f"d{i}"),
            F.sum(F.when(dec, y).otherwise(0)).alias(f"c{i}"),
        ]
    one = df.agg(*aggs)
    rows = []
    for i, sh in enumerate(shares):
        d, c = F.col(f"d{i}"), F.col(f"c{i}")
        base = F.col("P") / F.col("n")
        prec = c / F.when(d > 0, d)
        rows.append(
            F.struct(
                F.lit(float(sh)).alias("decline_share"),
                F.col(f"cut{i}").alias("score_cutoff"),
                d.cast("bigint").alias("declined"),
                c.cast("bigint").alias("caught"),
                (c / F.col("P")).alias("recall"),
                prec.alias("precision"),
                (prec / base).alias("lift"),
                (d - c).cast("bigint").alias("good_declined"),
                (F.col("P") - c).cast("bigint").alias("missed"),
            )
        )
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R^2 (against the mean of the evaluated rows), one row or one per group of ``by``."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    err = a - p
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.try_divide(F.sum(err * err), F.var_pop(a) * F.count(a))).alias("r2"),
    )


def prediction_rows(df: DataFrame, id_col: str, actual: str, predicted: str, extra: Sequence[str] = ()) -> DataFrame:
    """Actual, predicted, residual, absolute error; the largest error first, then the id."""
    res = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.select(
        id_col,
        *extra,
        F.col(actual).cast("double").alias("actual_loss_amount"),
        F.col(predicted).cast("double").alias("predicted_loss_amount"),
        res.alias("residual"),
        F.abs(res).alias("absolute_error"),
    ).orderBy(F.col("absolute_error").desc_nulls_last(), id_col)


def median_baseline(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Predict the training median for every test row."""
    med = exact_quantiles(train, [], target, [0.5], "m").select(F.col("m")[0]).scalar()
    return test.withColumn("baseline_prediction", med)


def bic(df: DataFrame, actual: str, predicted: str, n_params: int) -> DataFrame:
    """N ln(RSS/n) + k ln n, with the parameters per row.

    ``is_reliable`` is false from ``PARAMS_PER_ROW_LIMIT`` parameters a row on:
    there least squares can fit the rows exactly and BIC says nothing.  An
    exact fit (RSS = 0) has BIC minus infinity.
    """
    err = F.col(actual).cast("double") - F.col(predicted).cast("double")
    one = df.agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("rss"))
    return bic_of_sums(one.withColumn("n_params", F.lit(n_params)))


def bic_of_sums(sums: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``bic`` from ``n, rss, n_params`` already known, one row each."""
    n, k = F.col("n"), F.col("n_params")
    return sums.select(
        *keep,
        "n",
        "rss",
        "n_params",
        F.when(F.col("rss") == 0, F.lit(float("-inf"))).otherwise(n * F.log(F.col("rss") / n) + k * F.log(n)).alias("bic"),
        (k / n).alias("params_per_row"),
        (k / n < PARAMS_PER_ROW_LIMIT).alias("is_reliable"),
    )


def expected_loss(
    test_loans: DataFrame, severity_predictions: DataFrame, label: str, amount: str, predicted_severity: str
) -> DataFrame:
    """Modelled vs actual loss per funded loan (long, six rows).

    modelled = test loss rate x mean predicted severity (over the severity
    test rows); actual = total positive loss / funded test loans.
    """
    a = F.col(amount)
    t = test_loans.agg(
        F.count(F.lit(1)).cast("double").alias("test_loans"),
        (F.sum(F.col(label).cast("int")) / F.count(F.col(label))).alias("loss_rate"),
        (F.sum(F.when(a > 0, a).otherwise(0)).cast("double") / F.count(F.lit(1))).alias("actual_loss_per_loan"),
    )
    sev = severity_predictions.agg(F.avg(F.col(predicted_severity).cast("double")).alias("m")).scalar()
    one = t.select("*", sev.alias("mean_predicted_severity"))
    modelled = F.col("loss_rate") * F.col("mean_predicted_severity")
    gap = (modelled - F.col("actual_loss_per_loan")) / F.col("actual_loss_per_loan") * 100
    rows = [
        F.struct(F.lit(k).alias("metric"), v.alias("value"))
        for k, v in [
            ("test_loans", F.col("test_loans")),
            ("loss_rate", F.col("loss_rate")),
            ("mean_predicted_severity", F.col("mean_predicted_severity")),
            ("modelled_expected_loss_per_loan", modelled),
            ("actual_loss_per_loan", F.col("actual_loss_per_loan")),
            ("gap_pct", gap),
        ]
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rank_metrics_by_group(df: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """E1 and E2 for many models at once: ``group, roc_auc, average_precision`` in one pass.

    One running total over (group, falling score) serves all groups; what the
    groups before hold (one row per group, broadcast) is taken off again.
    """
    lab = F.col(label).cast("int")
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(group, score).agg(
        F.sum(lab).cast("bigint").alias("pos"), F.sum(1 - lab).cast("bigint").alias("neg")
    )
    run = running_totals(counts, [(group, False), (score, True)], {"tp": "pos", "fp": "neg"})
    totals = run.groupBy(group).agg(F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    base = totals.select(
        group, "P", "N", F.coalesce(F.sum("P").over(before), zero).alias("P0"), F.coalesce(F.sum("N").over(before), zero).alias("N0")
    )
    tp, fp = F.col("tp") - F.col("P0"), F.col("fp") - F.col("N0")
    return run.join(F.broadcast(base), group).groupBy(group).agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("N") - fp + F.col("neg") / 2.0)), F.max("P") * F.max("N")).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * (tp / (tp + fp))), F.max("P")).alias("average_precision"),
    )
