"""Model marts (training / severity) and fitted preparation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlake.config import GROUPER_MIN_COUNT, TRAIN_RARE_MIN_COUNT
from lendlake.operators import features as fx
from lendlake.plans.registry import portfolio, query
from lendlake.sources.fixture import FEATURE_COLUMNS, FIXTURE_CUTOFF, FIXTURE_SENTINELS

CATS = ["feat_001", "feat_003", "feat_004", "feat_015", "feat_041"]
SENT = [s.column for s in FIXTURE_SENTINELS]
REST = [c for c in FEATURE_COLUMNS if c not in CATS and c not in SENT]


def _sentinel_sql(prefix: str = "") -> str:
    out = []
    for s in FIXTURE_SENTINELS:
        c, t = f"{prefix}{s.column}", s.threshold
        out.append(f"CASE WHEN {c} >= {t} THEN NULL ELSE {c} END AS {s.column}")
        out.append(f"CASE WHEN {c} >= {t} THEN 1 ELSE 0 END AS is_unobserved_{s.column}")
    return ", ".join(out)


_SPLIT = f"CASE WHEN received_date < DATE '{FIXTURE_CUTOFF}' THEN 'train' ELSE 'test' END"

# A loan keeps its level if enough loans of that level came in before the cutoff.
TRAINING_SQL = f"""
SELECT loan_id, {_SPLIT} AS split, is_loss, received_date,
    CASE WHEN (SELECT count(*) FROM loans_joined o WHERE o.feat_001 = l.feat_001 AND o.received_date < DATE '{FIXTURE_CUTOFF}')
        >= {TRAIN_RARE_MIN_COUNT} THEN feat_001 ELSE 'OTHER' END AS feat_001_grouped,
    feat_003, feat_004, feat_015, feat_041,
    {_sentinel_sql()},
    {', '.join(REST)}
FROM loans_joined l
"""

SEVERITY_SQL = f"""
SELECT loan_id, {_SPLIT} AS split, CAST(loss_amount AS DOUBLE) AS loss_amount, received_date, is_loss,
    feat_001, feat_003, feat_004, feat_015, feat_041,
    {_sentinel_sql()},
    {', '.join(REST)}
FROM loans_joined WHERE loss_amount > 0
"""


@query("ml_training_set", TRAINING_SQL)
def q_ml_training_set(spark, sf_dir):
    """Classifier mart (split, OTHER grouping, sentinels)."""
    p = portfolio(spark, sf_dir)
    return fx.training_set(p.joined, p.cfg)


@query("ml_severity_set", SEVERITY_SQL)
def q_ml_severity_set(spark, sf_dir):
    """Severity mart (positive losses, target kept)."""
    p = portfolio(spark, sf_dir)
    return fx.severity_set(p.joined, p.cfg)


# ---------------------------------------------------------------- fitted statistics

SEV_CATS = ["feat_001", "feat_003", "feat_041"]


@query(
    "fit_rare_levels",
    f"""
sev AS ({SEVERITY_SQL}),
lv AS (
    SELECT column_name, level, count(*) AS train_count FROM (
        {' UNION ALL '.join(f"SELECT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS level FROM sev WHERE split = 'train'" for c in SEV_CATS)}
    ) GROUP BY column_name, level
)
SELECT * FROM lv WHERE train_count >= {GROUPER_MIN_COUNT}
""",
)
def q_fit_rare_levels(spark, sf_dir):
    """M3 fit (+ M4): kept category levels of the severity pipeline."""
    p = portfolio(spark, sf_dir)
    sev = fx.severity_set(p.joined, p.cfg)
    return fx.fit_rare_levels(sev.where(F.col("split") == "train"), SEV_CATS)


TRAIN_NUM = ["feat_004", "feat_015"] + [x for s in FIXTURE_SENTINELS for x in (s.column, f"is_unobserved_{s.column}")] + REST


def _num_sql(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


@query(
    "fit_medians",
    f"""
ts AS ({TRAINING_SQL.strip()}),
tr AS (SELECT * FROM ts WHERE split = 'train')
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, median({_num_sql(c)}) AS median FROM tr" for c in TRAIN_NUM)}
""",
)
def q_fit_medians(spark, sf_dir):
    """M6 fit: exact medians of the numeric training columns."""
    p = portfolio(spark, sf_dir)
    ts = fx.booleans_to_int(fx.training_set(p.joined, p.cfg), keep=["is_loss"])
    return fx.fit_medians(ts.where(F.col("split") == "train"), TRAIN_NUM)


@query(
    "fit_scaler",
    f"""
ts AS ({TRAINING_SQL.strip()}),
tr AS (SELECT * FROM ts WHERE split = 'train'),
md AS (SELECT {', '.join(f"median({_num_sql(c)}) AS {c}" for c in TRAIN_NUM)} FROM tr)
{' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, round(avg(coalesce({_num_sql('tr.' + c)}, md.{c})), 6) AS mean, "
    f"round(CASE WHEN stddev_pop(coalesce({_num_sql('tr.' + c)}, md.{c})) = 0 THEN 1.0 ELSE stddev_pop(coalesce({_num_sql('tr.' + c)}, md.{c})) END, 6) AS scale "
    f"FROM tr CROSS JOIN md GROUP BY md.{c}"
    for c in TRAIN_NUM)}
""",
)
def q_fit_scaler(spark, sf_dir):
    """M6 + M7 fit: standardisation stats over median-imputed training columns."""
    p = portfolio(spark, sf_dir)
    ts = fx.booleans_to_int(fx.training_set(p.joined, p.cfg), keep=["is_loss"])
    train = ts.where(F.col("split") == "train")
    imputed = fx.impute_medians(train, fx.fit_medians(train, TRAIN_NUM), TRAIN_NUM)
    st = fx.fit_scaler(imputed, TRAIN_NUM)
    return st.select("column_name", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


@query(
    "class_weights",
    f"""
ts AS ({TRAINING_SQL.strip()}),
cc AS (SELECT is_loss, count(*) AS class_count FROM ts WHERE split = 'train' GROUP BY is_loss)
SELECT is_loss, class_count, CAST((SELECT sum(class_count) FROM cc) AS DOUBLE) / ((SELECT count(*) FROM cc) * class_count) AS class_weight
FROM cc
""",
)
def q_class_weights(spark, sf_dir):
    """Balanced class weights on the training rows."""
    p = portfolio(spark, sf_dir)
    ts = fx.training_set(p.joined, p.cfg)
    return fx.class_weights(ts.where(F.col("split") == "train"), "is_loss")


@query(
    "target_log",
    f"""
sev AS ({SEVERITY_SQL})
SELECT split, count(*) AS n, round(min(ln(1 + loss_amount)), 9) AS min_log_target,
    round(max(ln(1 + loss_amount)), 9) AS max_log_target, round(avg(ln(1 + loss_amount)), 6) AS mean_log_target
FROM sev GROUP BY split
""",
)
def q_target_log(spark, sf_dir):
    """log1p target range per split (the scoring clip range comes from train)."""
    p = portfolio(spark, sf_dir)
    sev = fx.log_target(fx.severity_set(p.joined, p.cfg), "loss_amount")
    return sev.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.min("log_target"), 9).alias("min_log_target"),
        F.round(F.max("log_target"), 9).alias("max_log_target"),
        F.round(F.avg("log_target"), 6).alias("mean_log_target"),
    )
