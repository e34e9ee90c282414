"""Global rank / running total (W1-W4) and the concentration marts.

Two forms of "rank every row by (amount desc, id) and carry a running sum":

* ``plain`` — ``Window.orderBy`` with no partition.  Spark moves every row to
  one task (``Exchange SinglePartition``); kept as the test form.
* ``scaled`` — the default.  Rows are written once in key ranges of the total
  order (``repartitionByRange`` samples the bounds).  The key includes the id,
  so one hot amount held by a third of all rows is spread over many ranges,
  and NULL keys sort where Spark sorts them.  Counts and sums per range (one
  row per range, broadcast) give each range's offset; a window partitioned by
  range finishes the job in parallel.  The bounds only steer balance: the
  result is exact and the same for any of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlake.config import TOP_SHARE_THRESHOLDS, PortfolioConfig
from lendlake.functions import ratio
from lendlake.session import stored

ROWS_PER_RANGE = 250_000


def running_totals(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    sums: dict[str, str],
    rank_col: str | None = None,
    method: str = "scaled",
    buckets: int | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Global ``row_number`` and ROWS running sums over a total order.

    ``order`` is a list of (column, descending); it must be a total order on
    the rows (end it with a unique key).  NULL keys come first in ascending
    and last in descending order, in both forms.  ``sums`` maps output name ->
    column.  With ``include_current=False`` the running sums stop at the
    previous row.  ``buckets`` is the number of ranges; by default it follows
    from the number of rows, ``ROWS_PER_RANGE`` each.
    """
    ocols = [F.col(c).desc() if d else F.col(c).asc() for c, d in order]
    upto = Window.currentRow if include_current else -1
    if method == "plain":
        w = Window.orderBy(*ocols)
        extra = [F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, upto)), F.lit(0)).alias(k) for k, v in sums.items()]
        if rank_col:
            extra.insert(0, F.row_number().over(w).cast("bigint").alias(rank_col))
        return df.select("*", *extra)
    if method != "scaled":
        raise ValueError(f"unknown method {method!r}")
    if buckets is None:
        df = stored(df, "totals-input")
        buckets = max(1, -(-df.count() // ROWS_PER_RANGE))
    ranges = df.repartitionByRange(buckets, *ocols).withColumn("__bucket", F.spark_partition_id())
    b = stored(ranges, "totals-ranges")
    # One row per range: the broadcast below is bounded by their number.
    stats = b.groupBy("__bucket").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__s_{k}") for k, v in sums.items()]
    )
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        "__bucket",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off_n"),
        *[F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__off_{k}") for k in sums],
    )
    with_off = b.join(F.broadcast(offsets), "__bucket")
    w = Window.partitionBy("__bucket").orderBy(*ocols)
    frame = w.rowsBetween(Window.unboundedPreceding, upto)
    out = [F.col(c) for c in df.columns]
    if rank_col:
        out.append((F.row_number().over(w) + F.col("__off_n")).cast("bigint").alias(rank_col))
    for k, v in sums.items():
        acc = F.coalesce(F.sum(v).over(frame), F.lit(0)) + F.col(f"__off_{k}")
        out.append(acc.cast(_acc_type(df, v)).alias(k))
    return with_off.select(*out)


def _acc_type(df: DataFrame, col_name: str) -> str:
    t = df.schema[col_name].dataType
    if t.typeName() == "decimal":
        return f"decimal({min(38, t.precision + 10)},{t.scale})"
    if t.typeName() in ("integer", "long", "short", "byte"):
        return "bigint"
    return "double"


def rank_running_sum(
    df: DataFrame,
    amount: str,
    id_col: str,
    rank_col: str = "loss_rank",
    cum_col: str = "cumulative_positive_loss_amount",
    method: str = "scaled",
    buckets: int | None = None,
) -> DataFrame:
    """``row_number()`` and a ROWS running sum over (amount desc, id asc)."""
    return running_totals(
        df, [(amount, True), (id_col, False)], {cum_col: amount}, rank_col=rank_col,
        method=method, buckets=buckets,
    )


# --------------------------------------------------------------------------
# Marts
# --------------------------------------------------------------------------


def loss_concentration(
    joined: DataFrame,
    cfg: PortfolioConfig | None = None,
    method: str = "scaled",
    buckets: int | None = None,
) -> DataFrame:
    """The concentration curve over loans with a positive loss."""
    cfg = cfg or PortfolioConfig()
    amt = F.col(cfg.amount_col)
    pos = joined.where(amt > 0).select(
        cfg.id_col,
        cfg.date_col,
        F.year(cfg.date_col).cast("int").alias("origination_year"),
        cfg.amount_col,
    )
    totals = pos.agg(
        F.count(F.lit(1)).alias("positive_loss_loan_count"),
        F.sum(amt).alias("portfolio_positive_loss_amount"),
    )
    ranked = rank_running_sum(pos, cfg.amount_col, cfg.id_col, method=method, buckets=buckets)
    packed = totals.select(F.struct(*totals.columns).alias("t")).scalar()
    r = ranked.select("*", packed.alias("__t")).select(*ranked.columns, "__t.*")
    return r.select(
        cfg.id_col,
        cfg.date_col,
        "origination_year",
        cfg.amount_col,
        "loss_rank",
        "positive_loss_loan_count",
        F.col("loss_rank").alias("cumulative_positive_loss_loan_count"),
        ratio("loss_rank", "positive_loss_loan_count").alias("cumulative_positive_loss_loan_share"),
        "portfolio_positive_loss_amount",
        "cumulative_positive_loss_amount",
        ratio("cumulative_positive_loss_amount", "portfolio_positive_loss_amount").alias(
            "cumulative_positive_loss_share"
        ),
    )


def concentration_summary(conc: DataFrame, thresholds: Sequence[str] = TOP_SHARE_THRESHOLDS, amount: str = "loss_amount") -> DataFrame:
    """A18/A19 (J6/J7 without the range join): loss held by the top n % of loans.

    The thresholds are a literal relation (S5) given as decimal text.

    ``cutoff = ceil(population * share)`` (exact decimal arithmetic).  All
    thresholds are answered by one aggregate pass of conditional sums instead
    of joining thresholds x detail on ``rank <= cutoff``.
    """
    n = F.col("positive_loss_loan_count")
    cut = {t: F.ceil(n * F.lit(Decimal(t))).cast("bigint") for t in thresholds}
    aggs = [
        F.max("positive_loss_loan_count").alias("pop"),
        F.max("portfolio_positive_loss_amount").alias("portfolio"),
    ]
    for k, t in enumerate(thresholds):
        aggs.append(F.max(cut[t]).alias(f"c{k}"))
        aggs.append(F.sum(F.when(F.col("loss_rank") <= cut[t], F.col(amount))).alias(f"s{k}"))
    one = conc.agg(*aggs)
    rows = [
        F.struct(
            F.lit(Decimal(t)).alias("top_share_threshold"),
            F.col(f"c{k}").alias("positive_loss_loan_count"),
            F.col("pop").alias("positive_loss_loan_population"),
            ratio(F.col(f"c{k}"), F.col("pop")).alias("actual_loan_share"),
            F.col(f"s{k}").alias("loss_amount"),
            ratio(F.col(f"s{k}"), F.col("portfolio")).alias("loss_share"),
        )
        for k, t in enumerate(thresholds)
    ]
    return one.where(F.col("pop").isNotNull()).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
