"""Projection of the driver's TPC-H-style tables onto the loan data model.

One *order* plays one *loan*.  The same projection is expressed twice: as a
DataFrame plan (what the library runs) and as SQL text (the shared CTE of
every DuckDB twin in ``lendlake.plans.oracle``).  Both must stay in step.

Scale notes: line items are pre-aggregated per order (partial aggregation
before the shuffle).  Orders, still narrow, meet customers (broadcast only when
the optimizer's size estimate is under ``spark.sql.autoBroadcastJoinThreshold``)
and then the lines on the order key (sort-merge or shuffle-hash join chosen by
AQE), so the wide rows are made last and stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendlake.config import PortfolioConfig, Sentinel

# Fixed values of the fixture projection.
FIXTURE_CUTOFF = "2000-06-01"
FIXTURE_SENTINELS = [Sentinel("feat_066_min", 995), Sentinel("feat_030_max", 999999000)]
FIXTURE_CONFIG = PortfolioConfig(sentinels=list(FIXTURE_SENTINELS), train_cutoff=FIXTURE_CUTOFF)
# The seven base predictors used for the duplicate-vector check of FIXTURES.md.
BASE_FEATURES = ["feat_001", "feat_002", "feat_003", "feat_004", "feat_015", "feat_041", "feat_066_min"]

# Raw feature columns in their source order.
FEATURE_COLUMNS = [
    "feat_001",
    "feat_002",
    "feat_003",
    "feat_004",
    "feat_005",
    "feat_010_max",
    "feat_010_std",
    "feat_010_sum",
    "feat_015",
    "feat_020_max",
    "feat_020_std",
    "feat_020_sum",
    "feat_025_max",
    "feat_025_std",
    "feat_025_sum",
    "feat_030_max",
    "feat_041",
    "feat_066_min",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_aggregates(lineitem: DataFrame) -> DataFrame:
    rf, ls, disc = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_discount")
    term = (
        F.when((rf == "R") & (ls == "F") & (disc >= 0.07), F.col("l_extendedprice"))
        .when((rf == "A") & (ls == "F") & (disc <= 0.005), -F.col("l_quantity"))
        .otherwise(F.lit(0.0))
        .cast("decimal(12,2)")
    )
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(term).alias("loss_amount"),
        F.min("l_quantity").alias("feat_002"),
        F.round(F.max("l_extendedprice"), 2).alias("feat_010_max"),
        F.round(F.stddev_samp("l_extendedprice"), 6).alias("feat_010_std"),
        F.round(F.sum("l_extendedprice"), 2).alias("feat_010_sum"),
        F.max("l_discount").alias("feat_020_max"),
        F.round(F.stddev_samp("l_discount"), 8).alias("feat_020_std"),
        F.round(F.sum("l_discount"), 4).alias("feat_020_sum"),
        F.max("l_tax").alias("feat_025_max"),
        F.round(F.stddev_samp("l_tax"), 8).alias("feat_025_std"),
        F.round(F.sum("l_tax"), 4).alias("feat_025_sum"),
        F.max(F.when(rf == "A", F.col("l_extendedprice"))).alias("feat_030_max"),
        F.max(F.when(rf == "R", F.col("l_quantity"))).alias("feat_066_min"),
    )


@dataclass
class RawTables:
    loans: DataFrame
    features: DataFrame
    base: DataFrame | None = None  # the shared orders x lines x customer plan


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """Raw ``loans`` (4 columns) and ``loan_features`` (loan_id + predictors)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    lines = _line_aggregates(table(spark, sf_dir, "lineitem"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    base = base.join(lines, base.o_orderkey == lines.l_orderkey, "left")
    return raw_tables_from(base)


def with_copies(base: DataFrame) -> DataFrame:
    """``base`` with ``copies``, how many of its rows share the order key; rows that were joined on it need not move."""
    return base.withColumn("copies", F.count(F.lit(1)).over(Window.partitionBy("o_orderkey")))


def raw_tables_from(base: DataFrame) -> RawTables:
    """Project the shared orders x lines x customer plan onto the two raw tables."""
    loans, features = raw_columns()
    return RawTables(loans=base.select(*loans), features=base.select(*features), base=base)


def raw_columns() -> tuple[list[Column], list[Column]]:
    """Columns of the two raw tables over the shared plan."""
    loan_id = F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias("loan_id")

    loans = [
        loan_id,
        F.col("o_orderdate").cast("date").alias("received_date"),
        ((F.coalesce(F.col("loss_amount"), F.lit(0)) > 0) != ((F.col("o_orderkey") % 97) == 0)).alias("is_loss"),
        F.col("loss_amount"),
    ]
    acct = F.col("c_acctbal")
    feats = [
        loan_id,
        F.when(
            acct >= 0, F.concat(F.lit("IND_"), F.floor(acct / 100).cast("int").cast("string"))
        ).alias("feat_001"),
        "feat_002",
        F.col("c_mktsegment").alias("feat_003"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("feat_004"),
        F.col("o_totalprice").alias("feat_005"),
        "feat_010_max",
        "feat_010_std",
        "feat_010_sum",
        (F.col("o_orderstatus") == "F").alias("feat_015"),
        "feat_020_max",
        "feat_020_std",
        "feat_020_sum",
        "feat_025_max",
        "feat_025_std",
        "feat_025_sum",
        F.coalesce(F.col("feat_030_max"), F.lit(999999999.0)).alias("feat_030_max"),
        F.col("o_orderpriority").alias("feat_041"),
        F.coalesce(F.col("feat_066_min"), F.lit(999.0)).alias("feat_066_min"),
    ]
    return loans, feats


# --------------------------------------------------------------------------
# The same projection as SQL (DuckDB dialect, also valid Spark SQL except for
# EXCLUDE).  ``stg_loans``, ``stg_loan_features`` and ``loans_joined`` are the
# CTE names every twin query builds on.
# --------------------------------------------------------------------------

FIXTURE_SQL = """
li_agg AS (
    SELECT
        l_orderkey,
        sum(CAST(CASE
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.07 THEN l_extendedprice
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_discount <= 0.005 THEN -l_quantity
            ELSE 0.0 END AS DECIMAL(12,2))) AS loss_amount,
        min(l_quantity) AS feat_002,
        round(max(l_extendedprice), 2) AS feat_010_max,
        round(stddev_samp(l_extendedprice), 6) AS feat_010_std,
        round(sum(l_extendedprice), 2) AS feat_010_sum,
        max(l_discount) AS feat_020_max,
        round(stddev_samp(l_discount), 8) AS feat_020_std,
        round(sum(l_discount), 4) AS feat_020_sum,
        max(l_tax) AS feat_025_max,
        round(stddev_samp(l_tax), 8) AS feat_025_std,
        round(sum(l_tax), 4) AS feat_025_sum,
        max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS feat_030_max,
        max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS feat_066_min
    FROM lineitem
    GROUP BY l_orderkey
),
raw_base AS (
    SELECT o.*, li.*
    FROM orders o LEFT JOIN li_agg li ON o.o_orderkey = li.l_orderkey
),
raw_loans AS (
    SELECT
        concat('L', CAST(o_orderkey AS VARCHAR)) AS loan_id,
        CAST(o_orderdate AS DATE) AS received_date,
        (coalesce(loss_amount, 0) > 0) <> (o_orderkey % 97 = 0) AS is_loss,
        loss_amount
    FROM raw_base
),
raw_features AS (
    SELECT
        concat('L', CAST(o_orderkey AS VARCHAR)) AS loan_id,
        CASE WHEN c_acctbal >= 0
            THEN concat('IND_', CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR)) END AS feat_001,
        feat_002,
        c_mktsegment AS feat_003,
        o_orderpriority IN ('1-URGENT', '2-HIGH') AS feat_004,
        o_totalprice AS feat_005,
        feat_010_max, feat_010_std, feat_010_sum,
        o_orderstatus = 'F' AS feat_015,
        feat_020_max, feat_020_std, feat_020_sum,
        feat_025_max, feat_025_std, feat_025_sum,
        coalesce(feat_030_max, 999999999.0) AS feat_030_max,
        o_orderpriority AS feat_041,
        coalesce(feat_066_min, 999.0) AS feat_066_min
    FROM raw_base b LEFT JOIN customer c ON b.o_custkey = c.c_custkey
),
stg_loans AS (
    SELECT
        CAST(loan_id AS VARCHAR) AS loan_id,
        CAST(received_date AS DATE) AS received_date,
        CAST(is_loss AS BOOLEAN) AS is_loss,
        CAST(loss_amount AS DECIMAL(12,2)) AS loss_amount
    FROM raw_loans
),
stg_loan_features AS (
    SELECT
        CAST(loan_id AS VARCHAR) AS loan_id,
        CAST(feat_001 AS VARCHAR) AS feat_001,
        CAST(feat_003 AS VARCHAR) AS feat_003,
        CAST(feat_004 AS BOOLEAN) AS feat_004,
        CAST(feat_015 AS BOOLEAN) AS feat_015,
        CAST(feat_041 AS VARCHAR) AS feat_041,
        CAST(COLUMNS(* EXCLUDE (loan_id, feat_001, feat_003, feat_004, feat_015, feat_041)) AS DOUBLE)
    FROM raw_features
),
loans_joined AS (
    SELECT l.loan_id, l.received_date, l.is_loss, l.loss_amount, f.* EXCLUDE (loan_id)
    FROM stg_loans l LEFT JOIN stg_loan_features f ON l.loan_id = f.loan_id
)
"""


def with_fixture(body: str) -> str:
    """Prefix a twin query with the shared fixture CTEs.

    ``body`` may start with ``WITH``-less CTE definitions separated by commas
    (``"x AS (...), y AS (...) SELECT ..."``) or with a plain ``SELECT``; a body
    that refers to itself starts with ``RECURSIVE``.
    """
    body = body.strip()
    if body.startswith("RECURSIVE"):
        return "WITH RECURSIVE " + FIXTURE_SQL.strip() + ",\n" + body.removeprefix("RECURSIVE").strip()
    if body.upper().startswith("SELECT") or body.startswith("("):
        return "WITH " + FIXTURE_SQL.strip() + "\n" + body
    return "WITH " + FIXTURE_SQL.strip() + ",\n" + body
