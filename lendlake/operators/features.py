"""Leakage-safe feature preparation.

Fixed rules (split, sentinel handling, rare-level collapse learned on train
rows) build the two model marts.  Fitted statistics are plain aggregates over
the training rows, one pass each, so they can be checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from lendlake.config import (
    GROUPER_LABEL,
    GROUPER_MIN_COUNT,
    MISSING_CATEGORY,
    TRAIN_RARE_LABEL,
    TRAIN_RARE_MIN_COUNT,
    PortfolioConfig,
)
from lendlake.functions import sentinel_flag, sentinel_to_null, split_label
from lendlake.session import stored


def _cfg(cfg):
    return cfg or PortfolioConfig()


def _sentinel_block(df: DataFrame, cfg: PortfolioConfig) -> list:
    cols = []
    for s in cfg.sentinels:
        cols.append(sentinel_to_null(F.col(s.column), s.threshold).alias(s.column))
        cols.append(sentinel_flag(F.col(s.column), s.threshold).alias(f"is_unobserved_{s.column}"))
    return cols


def _rest(df: DataFrame, cfg: PortfolioConfig, extra: Sequence[str] = ()) -> list[str]:
    skip = set(cfg.outcome_cols) | set(cfg.categorical) | {s.column for s in cfg.sentinels} | {"split", *extra}
    return [c for c in df.columns if c not in skip]


def label_split(df: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """Chronological split column."""
    cfg = _cfg(cfg)
    return df.withColumn("split", split_label(cfg.date_col, cfg.train_cutoff))


def train_level_counts(labelled: DataFrame, column: str) -> DataFrame:
    """A20 fit: level counts over the training rows only."""
    return labelled.where(F.col("split") == "train").groupBy(column).agg(F.count(F.lit(1)).alias("train_loan_count"))


def lookup(rows: DataFrame, value: Column, table: DataFrame, small: bool) -> DataFrame:
    """``rows`` with the columns of ``table`` at the level ``value``; NULL where ``table`` lacks it.

    ``table`` has one row per ``level``.  A ``small`` one is broadcast, so the
    wide rows are not shuffled on a hot level; else the rows of a level are
    spread over ``LEVEL_SALTS`` salts.
    """
    keyed = rows.withColumn("__value", value)
    if small:
        return keyed.join(F.broadcast(table), keyed["__value"] == table["level"], "left").drop("__value", "level")
    salted = keyed.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(LEVEL_SALTS)).cast("int"))
    spread = table.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(LEVEL_SALTS - 1))))
    on = (salted["__value"] == spread["level"]) & (salted["__salt"] == spread["__at"])
    return salted.join(spread, on, "left").drop("__salt", "__at", "__value", "level")


def with_grouped_level(labelled: DataFrame, column: str, min_count: int, rare_label: str) -> DataFrame:
    """``column``_grouped, the level if enough training rows have it, else ``rare_label``.

    The table of kept levels (at most training rows / ``min_count``) is counted
    first; up to ``MAX_BROADCAST_LEVELS`` it is broadcast (``lookup``).  A NULL
    level is never kept.
    """
    kept = train_level_counts(labelled, column).where(F.col("train_loan_count") >= min_count).where(F.col(column).isNotNull())
    kept = stored(kept.select(F.col(column).alias("level"), F.col(column).alias("__kept")), "levels")
    joined = lookup(labelled, F.col(column), kept, kept.count() <= MAX_BROADCAST_LEVELS)
    return joined.withColumn(f"{column}_grouped", F.coalesce(F.col("__kept"), F.lit(rare_label))).drop("__kept")


def training_set(
    joined: DataFrame,
    cfg: PortfolioConfig | None = None,
    min_count: int = TRAIN_RARE_MIN_COUNT,
    rare_label: str = TRAIN_RARE_LABEL,
) -> DataFrame:
    """Classifier mart: split, rare-level collapse (train counts), sentinels, no loss amount."""
    cfg = _cfg(cfg)
    lab = label_split(joined, cfg)
    f = cfg.rare_feature
    j = with_grouped_level(lab, f, min_count, rare_label)
    grouped = F.col(f"{f}_grouped")
    others = [c for c in cfg.categorical if c != f]
    return j.select(
        cfg.id_col,
        "split",
        cfg.label_col,
        cfg.date_col,
        grouped,
        *others,
        *_sentinel_block(j, cfg),
        *_rest(lab, cfg),
    )


def severity_set(joined: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """Severity mart: positive losses only, loss amount is the target."""
    cfg = _cfg(cfg)
    lab = label_split(joined.where(F.col(cfg.amount_col) > 0), cfg)
    return lab.select(
        cfg.id_col,
        "split",
        cfg.amount_col,
        cfg.date_col,
        cfg.label_col,
        *cfg.categorical,
        *_sentinel_block(lab, cfg),
        *_rest(lab, cfg),
    )


MAX_BROADCAST_LEVELS = 200_000
LEVEL_SALTS = 32

# --------------------------------------------------------------------------
# Column routing
# --------------------------------------------------------------------------


def route_columns(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """M1: categorical = string columns, numeric = numeric or boolean columns.

    Raises when a column is claimed by neither selector (C15).
    """
    cat, num, other = [], [], []
    for fld in df.schema.fields:
        if fld.name in exclude:
            continue
        if isinstance(fld.dataType, StringType):
            cat.append(fld.name)
        elif isinstance(fld.dataType, (NumericType, BooleanType)):
            num.append(fld.name)
        else:
            other.append(fld.name)
    if other:
        raise ValueError(f"feature columns matched neither selector: {other}")
    return cat, num


def booleans_to_int(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Boolean features -> 0/1 integers (the target stays boolean)."""
    return df.select(
        *[
            F.col(f.name).cast("int").alias(f.name)
            if isinstance(f.dataType, BooleanType) and f.name not in keep
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --------------------------------------------------------------------------
# Fitted statistics (train rows only)
# --------------------------------------------------------------------------


def fit_rare_levels(
    train: DataFrame, columns: Sequence[str], min_count: int = GROUPER_MIN_COUNT, impute_first: bool = True
) -> DataFrame:
    """M3 fit: levels with at least ``min_count`` training rows, per column.

    Long table (column_name, level, train_count) from one scan: the columns
    are unpivoted and counted together, so the shuffle carries one row per
    (column, level) after map-side partial aggregation.  NULL is imputed to
    ``MISSING`` first when ``impute_first`` (the reference groups after
    stringifying NULL; see README).
    """
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) if impute_first else F.col(c).cast("string")).alias("level"),
        )
        for c in columns
    ]
    long = train.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    counts = long.groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("train_count"))
    return counts.where(F.col("train_count") >= min_count)


def apply_rare_levels(
    df: DataFrame, kept: DataFrame, columns: Sequence[str], rare_label: str = GROUPER_LABEL, impute_first: bool = True
) -> DataFrame:
    """M3 transform: levels not kept become ``rare_label`` (one ``lookup`` per column, its table counted first)."""
    sizes = {r["column_name"]: r["n"] for r in kept.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a column
    out = df
    for c in columns:
        value = F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) if impute_first else F.col(c).cast("string")
        table = kept.where(F.col("column_name") == c).select("level", F.col("level").alias("__kept"))
        found = lookup(out, value, table, sizes.get(c, 0) <= MAX_BROADCAST_LEVELS)
        out = found.withColumn(c, F.coalesce("__kept", F.lit(rare_label))).drop("__kept")
    return out


def fit_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M6 fit: exact (interpolated) median of each numeric column, one pass, long form."""
    from lendlake.operators.profiling import unpivot_values
    from lendlake.operators.quantiles import exact_quantiles

    long = unpivot_values(train, columns)
    med = exact_quantiles(long, ["column_name"], "value", [0.5], "__q").select("column_name", F.col("__q")[0].alias("median"))
    names = train.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    # Columns that are NULL on every training row keep a NULL median.
    return names.join(med, "column_name", "left")


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M7 fit: mean and population std per column (constant column -> scale 1)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    one = train.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m_{c}").alias("mean"),
            F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")).alias("scale"),
        )
        for c in columns
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (n_classes * n_class), one row per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    tot = counts.agg(F.sum("class_count").alias("n"), F.count(F.lit(1)).alias("k"))
    packed = tot.select(F.struct("n", "k").alias("t")).scalar()
    return counts.select(
        label,
        "class_count",
        (packed["n"].cast("double") / (packed["k"] * F.col("class_count"))).alias("class_weight"),
    )


def with_class_weight(df: DataFrame, weights: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the per-class weight (tiny: one row per class, broadcast)."""
    w = weights.select(F.col(label).alias("__lab"), F.col("class_weight").alias(out))
    return df.join(F.broadcast(w), df[label] == w["__lab"], "left").drop("__lab")


def log_target(df: DataFrame, target: str, out: str = "log_target") -> DataFrame:
    """log1p of the target."""
    return df.withColumn(out, F.log1p(F.col(target).cast("double")))


def hash_split(df: DataFrame, id_col: str, share: float = 0.2, seed: int = 42, out: str = "is_validation") -> DataFrame:
    """Reproducible validation split from a hash of the id (partitioning-invariant)."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(100)) < int(share * 100))

def impute_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """M6 transform: NULL -> fitted median (medians: long table column_name, median).

    The fitted table has one row per column; it is pivoted to one row and
    attached as a scalar subquery.
    """
    names = [c for c in df.columns]
    # Known pivot values avoid the extra job that discovers them.
    pivot = medians.groupBy().pivot("column_name", list(columns)) if columns else medians.groupBy().pivot("column_name")
    wide = pivot.agg(F.first("median"))
    cols = [c for c in wide.columns]
    packed = wide.select(F.struct(*cols).alias("m")).scalar()
    return df.select(*[F.coalesce(F.col(c).cast("double"), packed[c]).alias(c) if c in cols else F.col(c) for c in names])
