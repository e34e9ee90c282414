"""Typed staging of the raw tables (cast once) and the 1:1 outcome/feature join.

S1 scan, S2 aliasing, S3/S4 typed loads, S6 read-back, J1 join, P2 star-exclude.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.config import PortfolioConfig


def scan(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a raw table (parquet by default; any DataFrameReader format)."""
    return spark.read.format(fmt).options(**options).load(path)


def register_sources(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Publish DataFrames under logical names (logical name -> temp view)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def stage_loans(raw: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """S3: the four outcome columns cast to their business types."""
    return raw.select(*loan_columns(cfg or PortfolioConfig()))


def loan_columns(cfg: PortfolioConfig) -> list[Column]:
    return [
        F.col(cfg.id_col).cast("string").alias(cfg.id_col),
        F.col(cfg.date_col).cast("date").alias(cfg.date_col),
        F.col(cfg.label_col).cast("boolean").alias(cfg.label_col),
        F.col(cfg.amount_col).cast("decimal(12,2)").alias(cfg.amount_col),
    ]


def stage_features(raw: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """Explicit casts for ids/categories/booleans, every other column -> double.

    The "every other column" list is resolved from the schema at plan time, so
    new numeric predictors are picked up without code changes.
    """
    return raw.select(*feature_columns(raw.columns, cfg or PortfolioConfig()))


def feature_columns(columns: Sequence[str], cfg: PortfolioConfig) -> list[Column]:
    explicit = [cfg.id_col, *cfg.string_features, *cfg.boolean_features]
    typed = {cfg.id_col: "string"}
    typed.update({c: "string" for c in cfg.string_features})
    typed.update({c: "boolean" for c in cfg.boolean_features})
    ordered = [cfg.id_col] + [c for c in cfg.categorical if c in typed and c != cfg.id_col]
    ordered += [c for c in explicit if c not in ordered]
    rest = [c for c in columns if c not in typed]
    return [*[F.col(c).cast(typed[c]).alias(c) for c in ordered], *[F.col(c).cast("double").alias(c) for c in rest]]


def cast_failures(raw: DataFrame, casts: dict[str, str]) -> DataFrame:
    """S3 variant: per column, how many non-NULL raw values fail ``try_cast``.

    One aggregate pass; the result is one row per column.
    """
    aggs = [
        F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS {t})").isNull()).alias(c)
        for c, t in casts.items()
    ]
    wide = raw.agg(*aggs)
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failed_casts")) for c in casts])
        ).alias("r")
    ).select("r.*")


def join_loans(loans: DataFrame, features: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """J1 + P2: outcomes LEFT JOIN features on the id, features minus the id.

    Both sides are one row per id; at scale this is one sort-merge (or
    shuffle-hash) join on the id. Tables bucketed by the id join without
    a shuffle.
    """
    cfg = cfg or PortfolioConfig()
    f = features.withColumnRenamed(cfg.id_col, "__fid")
    joined = loans.join(f, loans[cfg.id_col] == f["__fid"], "left")
    return joined.select(*[loans[c] for c in loans.columns], *[f[c] for c in f.columns if c != "__fid"])


@dataclass
class Staged:
    loans: DataFrame
    features: DataFrame
    joined: DataFrame


def read_back(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Read a stored mart back, optionally filtered (pushed to the scan)."""
    df = spark.read.parquet(path)
    return df.where(where) if where else df
