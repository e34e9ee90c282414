"""Evaluation metrics on fixed formula scores (exactly checkable by SQL).

The classifier score and the severity prediction are fixed linear formulas
of the features, so every metric has a deterministic expected value; model
fits feed the same operators in ``models_q``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlake.operators import features as fx
from lendlake.operators import metrics as mx
from lendlake.operators import profiling as pf
from lendlake.plans.features_q import SEVERITY_SQL, TRAINING_SQL
from lendlake.plans.registry import portfolio, query

# Fixed formula scores (identical arithmetic in both engines).
SCORE_SQL = "round(coalesce(feat_020_max, 0) * 10 + coalesce(feat_025_max, 0) * 5, 4)"
THRESHOLD = 0.9
SEVERITY_PRED_SQL = "coalesce(feat_010_sum, 0) * 0.25"
# The shares of the report.
DECLINE_SHARES = [0.05, 0.10, 0.20, 0.30, 0.40, 0.50]


def score_col():
    return F.round(F.coalesce(F.col("feat_020_max"), F.lit(0.0)) * 10 + F.coalesce(F.col("feat_025_max"), F.lit(0.0)) * 5, 4)


def severity_pred_col():
    return F.coalesce(F.col("feat_010_sum"), F.lit(0.0)) * 0.25


def scored_test(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    ts = fx.training_set(p.joined, p.cfg).where(F.col("split") == "test")
    return ts.select("loan_id", "received_date", "is_loss", score_col().alias("score"),
                     (score_col() >= THRESHOLD).alias("predicted"))


def severity_scored(spark, sf_dir, split="test"):
    p = portfolio(spark, sf_dir)
    sev = fx.severity_set(p.joined, p.cfg).where(F.col("split") == split)
    return sev.select("loan_id", "received_date", "loss_amount", severity_pred_col().alias("predicted_loss_amount"))


_T = f"""
ts AS ({TRAINING_SQL.strip()}),
t AS (SELECT loan_id, received_date, is_loss, {SCORE_SQL} AS score, {SCORE_SQL} >= {THRESHOLD} AS predicted FROM ts WHERE split = 'test'),
c AS (SELECT score, CAST(sum(CAST(is_loss AS INTEGER)) AS BIGINT) AS pos, CAST(sum(1 - CAST(is_loss AS INTEGER)) AS BIGINT) AS neg
      FROM t WHERE score IS NOT NULL AND is_loss IS NOT NULL GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM c)"""

_S = f"""
sev AS ({SEVERITY_SQL}),
s AS (SELECT loan_id, received_date, loss_amount, {SEVERITY_PRED_SQL} AS predicted_loss_amount FROM sev WHERE split = 'test')"""


@query("roc_auc", _T + """,
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM c)
SELECT sum(pos * (neg_below + neg / 2.0)) / (max(P) * max(N)) AS roc_auc FROM r CROSS JOIN tot
""")
def q_roc_auc(spark, sf_dir):
    """ROC-AUC of the formula score on the test split (ties = 1/2)."""
    return mx.roc_auc(scored_test(spark, sf_dir), "score", "is_loss")


@query("average_precision", _T + """,
r AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
      sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM c)
SELECT round(sum(pos * (tp / (tp + fp))) / max(P), 12) AS average_precision FROM r CROSS JOIN tot
""")
def q_average_precision(spark, sf_dir):
    """Step-wise average precision."""
    out = mx.average_precision(scored_test(spark, sf_dir), "score", "is_loss")
    return out.select(F.round("average_precision", 12).alias("average_precision"))


@query("curve_points", _T + """,
r AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
      sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM c)
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / P AS tpr, fp / N AS fpr,
    tp / (tp + fp) AS precision, tp / P AS recall FROM r CROSS JOIN tot
""")
def q_curve_points(spark, sf_dir):
    """E5: ROC and precision-recall points per distinct threshold."""
    return mx.curve_points(scored_test(spark, sf_dir), "score", "is_loss")


@query("threshold_metrics", _T + """,
m AS (SELECT count(*) AS n,
    sum(CASE WHEN predicted AND is_loss THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN predicted AND NOT is_loss THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN NOT predicted AND is_loss THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN NOT predicted AND NOT is_loss THEN 1 ELSE 0 END) AS tn FROM t),
pr AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall FROM m)
SELECT coalesce(CAST(tp + tn AS DOUBLE) / nullif(n, 0), 0.0) AS accuracy, precision, recall,
    coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1_score FROM pr
""")
def q_threshold_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1 at the fixed threshold."""
    return mx.threshold_metrics(scored_test(spark, sf_dir), "predicted", "is_loss")


@query("confusion", _T + """
SELECT CAST(is_loss AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted, count(*) AS loans
FROM (SELECT * FROM t UNION ALL SELECT NULL, NULL, a, NULL, p FROM (VALUES (true, true), (true, false), (false, true), (false, false)) v(a, p))
GROUP BY 1, 2
""".replace("count(*) AS loans", "CAST(count(loan_id) AS BIGINT) AS loans"))
def q_confusion(spark, sf_dir):
    """Confusion matrix (all four cells)."""
    return mx.confusion(scored_test(spark, sf_dir), "predicted", "is_loss")


# Independent of the operator: bins by a join on the ordered distinct edges.
_DECILES = """,
edges AS (
    SELECT edge, row_number() OVER (ORDER BY edge) - 1 AS b
    FROM (SELECT DISTINCT unnest(quantile_cont(score, [i / 10 FOR i IN range(11)])) AS edge FROM t)
),
binned AS (SELECT t.*, (10 - greatest(coalesce(e.b, 0), 0))::INT AS risk_decile FROM t ASOF LEFT JOIN edges e ON t.score > e.edge)"""


@query("risk_deciles", _T + _DECILES + """
SELECT loan_id, received_date, CAST(is_loss AS INTEGER) AS actual_is_loss, score, risk_decile FROM binned
""")
def q_risk_deciles(spark, sf_dir):
    """Prediction rows with the risk decile (1 = riskiest)."""
    t = scored_test(spark, sf_dir)
    d = mx.with_risk_decile(t, "score")
    return d.select("loan_id", "received_date", F.col("is_loss").cast("int").alias("actual_is_loss"), "score", "risk_decile")


@query("decile_table", _T + _DECILES + """
SELECT risk_decile, count(*) AS loans, count(*) FILTER (is_loss) AS losses, avg(is_loss::INT) AS loss_rate,
    (avg(is_loss::INT) - last_value(avg(is_loss::INT)) OVER (ORDER BY risk_decile ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) * 100
        AS lead_over_last_pp
FROM binned GROUP BY risk_decile
""")
def q_decile_table(spark, sf_dir):
    """Observed loss rate by risk decile."""
    d = mx.with_risk_decile(scored_test(spark, sf_dir), "score")
    return mx.decile_table(d, "risk_decile", "is_loss")


@query("decline_table", _T + f""",
asked AS (
    SELECT unnest({DECLINE_SHARES}) AS decline_share, unnest(quantile_cont(score, {[1 - x for x in DECLINE_SHARES]})) AS cutoff FROM t),
r AS (
    SELECT decline_share, any_value(cutoff) AS cutoff, count(*) AS n, count(*) FILTER (is_loss) AS losses,
        count(*) FILTER (score >= cutoff) AS d, count(*) FILTER (score >= cutoff AND is_loss) AS c
    FROM asked JOIN t ON true GROUP BY decline_share)
SELECT decline_share, round(cutoff, 6) AS score_cutoff, d AS declined, c AS caught, c / losses AS recall, c / d AS precision,
    (c / d) / (losses / n) AS lift, d - c AS good_declined, losses - c AS missed FROM r
""")
def q_decline_table(spark, sf_dir):
    """Decline-the-riskiest-N% table."""
    out = mx.decline_table(scored_test(spark, sf_dir), "score", "is_loss", DECLINE_SHARES)
    return out.withColumn("score_cutoff", F.round("score_cutoff", 6))


@query("regression_metrics", _S + """
SELECT count(*) AS n, round(avg(abs(loss_amount - predicted_loss_amount)), 6) AS mae,
    round(sqrt(avg((loss_amount - predicted_loss_amount) ^ 2)), 6) AS rmse,
    round(1 - sum((loss_amount - predicted_loss_amount) ^ 2) / (var_pop(loss_amount) * count(loss_amount)), 9) AS r2
FROM s
""")
def q_regression_metrics(spark, sf_dir):
    """MAE / RMSE / R^2 of the formula severity prediction."""
    out = mx.regression_metrics(severity_scored(spark, sf_dir), "loss_amount", "predicted_loss_amount")
    return out.select("n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"), F.round("r2", 9).alias("r2"))


@query("prediction_rows", _S + """
SELECT loan_id, received_date, loss_amount AS actual_loss_amount, predicted_loss_amount,
    loss_amount - predicted_loss_amount AS residual, abs(loss_amount - predicted_loss_amount) AS absolute_error FROM s
""")
def q_prediction_rows(spark, sf_dir):
    """Regression prediction rows (actual, predicted, residual, |error|)."""
    return mx.prediction_rows(severity_scored(spark, sf_dir), "loan_id", "loss_amount", "predicted_loss_amount", ["received_date"])


@query("residual_summary", _S + """
SELECT count(*) AS count, round(avg(r), 4) AS mean, round(stddev_samp(r), 4) AS std, min(r) AS min,
    round(quantile_cont(r, 0.25), 6) AS q25, round(quantile_cont(r, 0.5), 6) AS q50, round(quantile_cont(r, 0.75), 6) AS q75, max(r) AS max
FROM (SELECT loss_amount - predicted_loss_amount AS r FROM s)
""")
def q_residual_summary(spark, sf_dir):
    """describe() of the residuals."""
    rows = mx.prediction_rows(severity_scored(spark, sf_dir), "loan_id", "loss_amount", "predicted_loss_amount")
    d = pf.describe(rows, "residual")
    return d.select("count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
                    F.round("q25", 6).alias("q25"), F.round("q50", 6).alias("q50"), F.round("q75", 6).alias("q75"), "max")


@query("median_baseline", f"""
sev AS ({SEVERITY_SQL}),
m AS (SELECT median(loss_amount) AS b FROM sev WHERE split = 'train'),
s AS (SELECT loss_amount, b FROM sev CROSS JOIN m WHERE split = 'test')
SELECT max(b) AS baseline_prediction, count(*) AS n, round(avg(abs(loss_amount - b)), 6) AS mae,
    round(sqrt(avg((loss_amount - b) ^ 2)), 6) AS rmse,
    round(1 - sum((loss_amount - b) ^ 2) / (var_pop(loss_amount) * count(loss_amount)), 9) AS r2 FROM s
""")
def q_median_baseline(spark, sf_dir):
    """Training-median baseline and its test metrics."""
    train = severity_scored(spark, sf_dir, "train")
    test = mx.median_baseline(train, severity_scored(spark, sf_dir, "test"), "loss_amount")
    m = mx.regression_metrics(test, "loss_amount", "baseline_prediction")
    b = test.agg(F.max("baseline_prediction")).scalar()
    return m.select(b.alias("baseline_prediction"), "n", F.round("mae", 6).alias("mae"),
                    F.round("rmse", 6).alias("rmse"), F.round("r2", 9).alias("r2"))


@query("bic", _S + """
SELECT count(*) AS n, round(sum((loss_amount - predicted_loss_amount) ^ 2), 2) AS rss, 2 AS n_params,
    round(count(*) * ln(sum((loss_amount - predicted_loss_amount) ^ 2) / count(*)) + 2 * ln(count(*)), 6) AS bic,
    2 / count(*) AS params_per_row, 2 / count(*) < 0.8 AS is_reliable FROM s
""")
def q_bic(spark, sf_dir):
    """BIC of the formula severity model (k = 2) and the rows-per-parameter guard."""
    out = mx.bic(severity_scored(spark, sf_dir), "loss_amount", "predicted_loss_amount", 2)
    return out.select("n", F.round("rss", 2).alias("rss"), "n_params", F.round("bic", 6).alias("bic"), "params_per_row", "is_reliable")


@query("expected_loss", f"""
ts AS ({TRAINING_SQL.strip()}),
lj AS (SELECT l.*, t.split FROM loans_joined l JOIN ts t ON l.loan_id = t.loan_id WHERE t.split = 'test'),
{_S.strip()},
a AS (SELECT count(*) AS n, sum(CAST(is_loss AS INTEGER)) / count(is_loss) AS loss_rate,
    CAST(sum(CASE WHEN loss_amount > 0 THEN loss_amount ELSE 0 END) AS DOUBLE) / count(*) AS actual_loss_per_loan,
    (SELECT avg(predicted_loss_amount) FROM s) AS mean_predicted_severity FROM lj),
v AS (SELECT *, loss_rate * mean_predicted_severity AS modelled FROM a)
SELECT 'loss_rate' AS metric, round(loss_rate, 9) AS value FROM v
UNION ALL SELECT 'test_loans', n::DOUBLE FROM v
UNION ALL SELECT 'mean_predicted_severity', round(mean_predicted_severity, 6) FROM v
UNION ALL SELECT 'modelled_expected_loss_per_loan', round(modelled, 6) FROM v
UNION ALL SELECT 'actual_loss_per_loan', round(actual_loss_per_loan, 6) FROM v
UNION ALL SELECT 'gap_pct', round((modelled - actual_loss_per_loan) / actual_loss_per_loan * 100, 6) FROM v
""")
def q_expected_loss(spark, sf_dir):
    """Portfolio expected loss per funded test loan, modelled vs actual."""
    p = portfolio(spark, sf_dir)
    test_loans = fx.label_split(p.joined, p.cfg).where(F.col("split") == "test")
    out = mx.expected_loss(test_loans, severity_scored(spark, sf_dir), "is_loss", "loss_amount", "predicted_loss_amount")
    digits = F.when(F.col("metric") == "loss_rate", F.round("value", 9)).otherwise(F.round("value", 6))
    return out.select("metric", digits.alias("value"))
