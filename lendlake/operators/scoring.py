"""Expected-loss scoring.

The original scores one id at a time from in-memory stores.  Here a whole
set of ids is scored in one distributed pass: ids are joined to the feature
rows, both fitted pipelines transform the batch, and the record is assembled
with column expressions.  Unknown ids are returned as a table (left anti
join) instead of raising one error per id.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.config import GROUPER_MIN_COUNT, PROBABILITY_C, SEVERITY_ALPHA, PortfolioConfig
from lendlake.functions import sentinel_flag, sentinel_to_null
from lendlake.operators import features as fx
from lendlake.operators import models as ml
from lendlake.operators.pipeline import Logistic, Ridge
from lendlake.session import stored

CLS_ID = ["loan_id", "split", "received_date", "is_loss"]
SEV_ID = ["loan_id", "split", "received_date", "is_loss", "loss_amount"]


@dataclass
class ScoringModels:
    """Both fitted pipelines (preparation and model each) and what the record needs beside them."""

    probability: PipelineModel
    severity: PipelineModel
    severity_log_range: tuple[float, float]
    training_cutoff: str
    metadata: dict = field(default_factory=dict)


def scoring_rows(joined: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Every loan with the features of both models, from one projection.

    J12: loans in the severity population keep their own level of the rare
    feature; for all others the grouped level of the training mart stands in.
    """
    labelled = fx.label_split(joined, cfg)
    f = cfg.rare_feature
    grouped = fx.with_grouped_level(labelled, f, fx.TRAIN_RARE_MIN_COUNT, fx.TRAIN_RARE_LABEL)
    sent = []
    for s in cfg.sentinels:
        sent += [sentinel_to_null(F.col(s.column), s.threshold).alias(s.column),
                 sentinel_flag(F.col(s.column), s.threshold).alias(f"is_unobserved_{s.column}")]
    skip = set(cfg.outcome_cols) | set(cfg.categorical) | {s.column for s in cfg.sentinels} | {"split"}
    own = F.when(F.col(cfg.amount_col) > 0, F.col(f)).otherwise(F.col(f"{f}_grouped"))
    return grouped.select(
        cfg.id_col, "split", cfg.amount_col, cfg.date_col, cfg.label_col, f"{f}_grouped", own.alias(f),
        *[c for c in cfg.categorical if c != f], *sent, *[c for c in labelled.columns if c not in skip],
    )


def fit_scoring_models(joined: DataFrame, cfg: PortfolioConfig, C: float = PROBABILITY_C, alpha: float = SEVERITY_ALPHA) -> ScoringModels:
    """G1: fit the probability and severity pipelines on their training rows."""
    ts = stored(fx.booleans_to_int(fx.training_set(joined, cfg), keep=["is_loss"]).withColumn("label", F.col("is_loss").cast("double")), "scoring")
    cat, num = fx.route_columns(ts.drop("label"), CLS_ID)
    train = ts.where(F.col("split") == "train")
    pre = ml.fit_preprocessor(train, cat, num)
    weights = fx.class_weights(train, "is_loss")
    tr = stored(fx.with_class_weight(pre.transform(train), weights, "is_loss"), "scoring")
    prob = Logistic(C=C).fit(tr)

    sev = fx.booleans_to_int(fx.severity_set(joined, cfg), keep=["is_loss"])
    scat, snum = fx.route_columns(sev, SEV_ID)
    sev = stored(fx.log_target(sev, "loss_amount", "label"), "scoring")
    strain = sev.where(F.col("split") == "train")
    spre = ml.fit_preprocessor(strain, scat, snum, group_rare=True, rare_min_count=GROUPER_MIN_COUNT)
    st = stored(spre.transform(strain), "scoring")
    agg = st.agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    smodel = Ridge(alpha=alpha).fit(st)
    meta = {
        "probability": {"kind": "balanced logistic regression", "C": C},
        "severity": {"kind": "ridge on the log of one plus the loss", "alpha": alpha, "training_rows": int(agg["n"])},
        "amounts_in": "USD",
    }
    return ScoringModels(pre.then(prob), spre.then(smodel), (float(agg["lo"]), float(agg["hi"])), cfg.train_cutoff, meta)


def assemble_record(
    df: DataFrame, probability: Column, severity_log: Column, lo: float | Column, hi: float | Column,
    cfg: PortfolioConfig | None = None,
) -> DataFrame:
    """Clip the log severity to the training range, build the record."""
    cfg = cfg or PortfolioConfig()
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    clipped = F.least(F.greatest(severity_log, lo_c), hi_c)
    lgd = F.expm1(clipped)
    return df.select(
        cfg.id_col,
        F.round(probability, 6).alias("probability_of_default"),
        F.round(lgd, 2).alias("predicted_loss_given_default"),
        F.round(probability * lgd, 2).alias("expected_loss_usd"),
        F.date_format(cfg.date_col, "yyyy-MM-dd").alias(cfg.date_col),
        F.col("split").alias("data_split"),
        (F.col("split") == "train").alias("scored_on_training_data"),
        F.coalesce(F.col(cfg.amount_col) > 0, F.lit(False)).alias("severity_in_population"),
        (~severity_log.between(lo_c, hi_c)).alias("severity_clipped"),
    )


def score_batch(models: ScoringModels, ids: DataFrame, joined: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Score a set of ids (one row each) with both models in one pass.

    Both feature sets come from one projection; the raw columns ride along as
    a struct past the first model's preparation, so nothing is joined twice.
    """
    rows = fx.booleans_to_int(scoring_rows(joined, cfg), keep=[cfg.label_col])
    rows = rows.join(ids.select(cfg.id_col).distinct(), cfg.id_col, "left_semi")
    packed = rows.withColumn("__raw", F.struct(*rows.columns))
    p = ml.positive_score(models.probability.transform(packed), "logistic", "__p")
    s = models.severity.transform(p.select("__raw.*", "__p"))
    lo, hi = models.severity_log_range
    return assemble_record(s, F.col("__p"), F.col("prediction"), lo, hi, cfg)


def missing_ids(ids: DataFrame, known: DataFrame, id_col: str = "loan_id") -> DataFrame:
    """Requested ids that are not in the warehouse."""
    return ids.select(id_col).distinct().join(known.select(id_col), id_col, "left_anti")


def save_models(models: ScoringModels, path: str) -> None:
    """K5: one saved pipeline per model, and the metadata."""
    spark = SparkSession.getActiveSession()
    models.probability.write().overwrite().save(f"{path}/probability")
    models.severity.write().overwrite().save(f"{path}/severity")
    meta = {"severity_log_range": list(models.severity_log_range), "training_cutoff": models.training_cutoff, "metadata": models.metadata}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_models(path: str) -> ScoringModels:
    """K5: load what ``save_models`` wrote."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return ScoringModels(
        PipelineModel.load(f"{path}/probability"), PipelineModel.load(f"{path}/severity"),
        tuple(meta["severity_log_range"]), meta["training_cutoff"], meta["metadata"],
    )
