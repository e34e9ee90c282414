"""Scoring record assembly on formula scores (G3-G6, J12) with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlake.operators import features as fx
from lendlake.operators import scoring as sc
from lendlake.plans.features_q import SEVERITY_SQL, TRAINING_SQL
from lendlake.plans.metrics_q import SCORE_SQL, score_col
from lendlake.plans.registry import portfolio, query
from lendlake.session import stored
from lendlake.sources.fixture import table

# Fixed formula stand-ins for the two fitted models.
PROB_SQL = f"(({SCORE_SQL} + 0.013) / 1.7)"
SEV_LOG_SQL = "ln(1 + coalesce(feat_010_sum, 0) * 0.2)"


def _prob():
    return (score_col() + 0.013) / 1.7


def _sev_log():
    return F.log1p(F.coalesce(F.col("feat_010_sum"), F.lit(0.0)) * 0.2)


SCORE_RECORDS_SQL = f"""
ts AS ({TRAINING_SQL.strip()}),
sev AS ({SEVERITY_SQL}),
rng AS (SELECT min(ln(1 + loss_amount)) AS lo, max(ln(1 + loss_amount)) AS hi FROM sev WHERE split = 'train'),
b AS (
    SELECT t.loan_id, t.split, t.received_date, j.loss_amount, {PROB_SQL.replace('feat_', 't.feat_')} AS p,
        ln(1 + coalesce(j.feat_010_sum, 0) * 0.2) AS sl
    FROM ts t JOIN loans_joined j ON t.loan_id = j.loan_id
)
SELECT loan_id, round(p, 6) AS probability_of_default,
    round(exp(least(greatest(sl, lo), hi)) - 1, 2) AS predicted_loss_given_default,
    round(p * (exp(least(greatest(sl, lo), hi)) - 1), 2) AS expected_loss_usd,
    strftime(received_date, '%Y-%m-%d') AS received_date, split AS data_split,
    split = 'train' AS scored_on_training_data, coalesce(loss_amount > 0, false) AS severity_in_population,
    NOT (sl BETWEEN lo AND hi) AS severity_clipped
FROM b CROSS JOIN rng
"""


@query("score_records", SCORE_RECORDS_SQL)
def q_score_records(spark, sf_dir):
    """Expected-loss record for every loan (formula models)."""
    return formula_scores(spark, sf_dir)


def formula_rows(spark, sf_dir):
    """One row per loan with both formula models' inputs, from one projection."""
    p = portfolio(spark, sf_dir)
    rows = sc.scoring_rows(p.joined, p.cfg)
    return rows.select("loan_id", "split", "received_date", "loss_amount", "feat_001", score_col().alias("score"), _sev_log().alias("sl"))


def severity_range(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    sev = fx.log_target(fx.severity_set(p.joined, p.cfg).where(F.col("split") == "train"), "loss_amount")
    return sev.agg(F.min("log_target").alias("lo"), F.max("log_target").alias("hi"))


def formula_scores(spark, sf_dir):
    """Score records of all loans with the formula stand-ins."""
    rng = severity_range(spark, sf_dir)
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    return sc.assemble_record(formula_rows(spark, sf_dir), (F.col("score") + 0.013) / 1.7, F.col("sl"), lo, hi)


@query(
    "scoring_levels",
    f"""
ts AS ({TRAINING_SQL.strip()})
SELECT t.loan_id, CASE WHEN l.loss_amount > 0 THEN l.feat_001 ELSE t.feat_001_grouped END AS feat_001
FROM ts t JOIN loans_joined l USING (loan_id)
""",
)
def q_scoring_levels(spark, sf_dir):
    """The level the severity model sees, grouped outside its population."""
    return formula_rows(spark, sf_dir).select("loan_id", "feat_001")


@query(
    "score_missing_ids",
    """
req AS (SELECT DISTINCT concat('L', CAST(c_custkey AS VARCHAR)) AS loan_id FROM customer)
SELECT r.loan_id FROM req r WHERE NOT EXISTS (SELECT 1 FROM stg_loans l WHERE l.loan_id = r.loan_id)
""",
)
def q_score_missing_ids(spark, sf_dir):
    """Requested ids (one per customer key) that are not in the warehouse."""
    p = portfolio(spark, sf_dir)
    req = table(spark, sf_dir, "customer").select(F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("loan_id"))
    return sc.missing_ids(req, p.loans)


@query("stream_score_records", SCORE_RECORDS_SQL)
def q_stream_score_records(spark, sf_dir):
    """Streaming G2: ids arrive as files and are scored micro-batch by micro-batch.

    The clip range and the feature rows are prepared once; each batch joins
    the stored rows, and the stored output is read back.
    """
    import uuid

    from lendlake.plans.registry import staging_folder
    from lendlake.streaming.scoring import score_stream

    p = portfolio(spark, sf_dir)
    base = f"{staging_folder(spark, sf_dir)}/stream-{uuid.uuid4().hex[:8]}"
    p.loans.select("loan_id").repartition(4).write.parquet(f"{base}/ids")
    rows = stored(formula_rows(spark, sf_dir), "scoring-rows")
    bounds = severity_range(spark, sf_dir).first()

    def score(ids):
        wanted = rows.join(ids.select("loan_id").distinct(), "loan_id", "left_semi")
        return sc.assemble_record(wanted, (F.col("score") + 0.013) / 1.7, F.col("sl"), bounds["lo"], bounds["hi"])

    q = score_stream(spark, f"{base}/ids", score, f"{base}/out", f"{base}/ckpt", files_per_batch=2)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id")
