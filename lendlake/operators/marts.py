"""Portfolio marts: KPI record (long + wide), cohorts, segmentation, bands.

Every mart is a function ``DataFrame -> DataFrame``.  One-row results
(portfolio totals, window bounds) are attached with scalar subqueries
(``DataFrame.scalar()``): Spark runs them once and inlines the value, so no
row-multiplying join is planned and the large side never shuffles for them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.config import (
    KPI_DEFINITIONS,
    NULL_SEGMENT,
    SEGMENT_BAND_PP,
    SEGMENT_LABELS,
    SEGMENT_MIN_LOANS,
    SEVERITY_BANDS,
    TRAILING_MONTHS,
    PortfolioConfig,
)
from lendlake.operators.duplicates import repeats
from lendlake.operators.quantiles import exact_median
from lendlake.functions import (
    band_label,
    band_order,
    is_conflict,
    mean_of,
    null_to_segment,
    rate_of,
    ratio,
)
from lendlake.session import stored


def _cfg(cfg: PortfolioConfig | None) -> PortfolioConfig:
    return cfg or PortfolioConfig()


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row DataFrame to each row of ``df``.

    Planned as a scalar subquery (computed once, inlined as a value), which
    replaces the reference's ``CROSS JOIN`` with a one-row CTE.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("__row")).scalar()
    return df.select("*", packed.alias("__row")).select(*df.columns, "__row.*")


# --------------------------------------------------------------------------
# Cohort measures shared by the yearly and quarterly marts.
# --------------------------------------------------------------------------


def date_cube(loans: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """Everything that adds up, per date: one row a day, NULL date included.

    Totals, trailing windows and cohorts are sums over it, so the loans are
    read once for all of them.  Sums of cents are exact in any order.
    """
    cfg = _cfg(cfg)
    amt, lab = F.col(cfg.amount_col), F.col(cfg.label_col)
    conflict = is_conflict(lab, amt)
    severity = F.when(lab, amt)
    return loans.groupBy(F.col(cfg.date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("loans"),
        F.count(lab).alias("labelled"),
        F.sum(F.coalesce(lab.cast("int"), F.lit(0))).cast("bigint").alias("losses"),
        F.count_if(lab == F.lit(False)).alias("non_losses"),
        F.sum(F.coalesce(amt, F.lit(0))).alias("recorded"),
        F.sum(F.when(amt > 0, amt).otherwise(0)).alias("positive"),
        F.sum(F.when(amt < 0, amt).otherwise(0)).alias("recovered"),
        F.sum(severity).alias("severity"),
        F.count(severity).alias("severities"),
        F.max(amt).alias("largest"),
        F.sum(F.when(conflict, 1).otherwise(0)).alias("conflicts"),
        F.count_if(amt < 0).alias("recoveries"),
        F.count_if(amt.isNull()).alias("unknown_amounts"),
    )


def _share(total: str, count: str) -> Column:
    """Mean of a measure from its sum and count in the cube."""
    return F.sum(total).cast("double") / F.when(F.sum(count) != 0, F.sum(count))


def _cohort_measures(with_max: bool) -> list[Column]:
    out = [
        F.when(F.sum("labelled") > 0, F.sum("losses")).cast("bigint").alias("loss_loan_count"),
        _share("losses", "labelled").alias("observed_loss_rate"),
        F.sum("recorded").alias("total_recorded_loss_amount"),
        F.sum("positive").alias("total_positive_loss_amount"),
        _share("recorded", "loans").alias("average_loss_per_funded_loan"),
        _share("severity", "severities").alias("average_loss_severity"),
    ]
    return [*out, F.max("largest").alias("maximum_loss_amount")] if with_max else out


def cohort_aggregate(df: DataFrame, keys: Callable[[Column], list[Column]], cfg: PortfolioConfig, with_max: bool) -> DataFrame:
    """Cohort measures, with an exact distinct loan count and median per cohort; ``keys`` are functions of the date.

    The measures are rolled up from the cube.  The distinct count is its own
    aggregate (group by cohort + id, then count), joined back on the cohort
    key; both sides are one row per cohort.
    """
    cube = date_cube(df, cfg).select(*keys(F.col("day")), "*")
    names = cube.columns[: cube.columns.index("day")]
    main = cube.groupBy(*names).agg(*_cohort_measures(with_max))
    keyed = df.select(*keys(F.col(cfg.date_col)), cfg.id_col, cfg.label_col, cfg.amount_col)
    distinct = (
        keyed.select(*names, cfg.id_col)
        .where(F.col(cfg.id_col).isNotNull())
        .distinct()
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("funded_loan_count"))
    )
    j = main.join(distinct, [main[n].eqNullSafe(distinct[n]) for n in names], "left")
    measures = [c for c in main.columns if c not in names]
    out = j.select(
        *[main[n] for n in names],
        F.coalesce(distinct["funded_loan_count"], F.lit(0)).alias("funded_loan_count"),
        *[main[c] for c in measures],
    )
    med = exact_median(keyed.where(F.col(cfg.label_col)), names, cfg.amount_col, "median_loss_severity")
    joined = out.join(med, [out[n].eqNullSafe(med[n]) for n in names], "left")
    cols = [out[c] for c in out.columns]
    pos = out.columns.index("average_loss_severity") + 1
    cols.insert(pos, med["median_loss_severity"])
    return joined.select(*cols)


def portfolio_yearly(loans: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """One row per origination year (undated loans excluded)."""
    cfg = _cfg(cfg)
    dated = loans.where(F.col(cfg.date_col).isNotNull())
    return cohort_aggregate(dated, lambda d: [F.year(d).cast("int").alias("origination_year")], cfg, with_max=True)


def portfolio_quarterly(joined: DataFrame, cfg: PortfolioConfig | None = None) -> DataFrame:
    """A10: one row per origination quarter present in the data."""
    cfg = _cfg(cfg)

    def keys(d: Column) -> list[Column]:
        return [
            F.year(d).cast("int").alias("origination_year"),
            F.quarter(d).cast("int").alias("origination_quarter_number"),
            F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("origination_quarter_name"),
            F.trunc(d, "quarter").alias("origination_quarter_start"),
        ]

    grouped = cohort_aggregate(joined.where(F.col(cfg.date_col).isNotNull()), keys, cfg, with_max=False)
    key = F.concat(
        F.col("origination_year").cast("string"), F.lit("-"), F.col("origination_quarter_name")
    ).alias("origination_year_quarter_key")
    return grouped.select(key, *grouped.columns)


# --------------------------------------------------------------------------
# KPI record
# --------------------------------------------------------------------------


def loan_measures(joined: DataFrame, cfg: PortfolioConfig | None = None, months: int | None = None) -> DataFrame:
    """A1: the portfolio record (one row), with the trailing windows of A11 where ``months`` is given.

    All of it comes from the cube of one pass, but the distinct ids and the
    median, which are aggregates of their own, attached as scalar subqueries.
    """
    cfg = _cfg(cfg)
    loans = joined.select(*cfg.outcome_cols)
    cube = stored(date_cube(loans, cfg), "date-cube")
    main = cube.agg(
        F.min("day").alias("first_origination_date"),
        F.max("day").alias("last_origination_date"),
        F.datediff(F.max("day"), F.min("day")).cast("bigint").alias("origination_window_days"),
        F.when(F.sum("labelled") > 0, F.sum("losses")).cast("bigint").alias("loss_loan_count"),
        F.sum("non_losses").cast("bigint").alias("non_loss_loan_count"),
        _share("losses", "labelled").alias("portfolio_loss_rate"),
        F.sum("recorded").alias("total_recorded_loss_amount"),
        F.sum("positive").alias("total_positive_loss_amount"),
        F.sum("recovered").alias("total_net_recovery_amount"),
        _share("recorded", "loans").alias("average_loss_per_funded_loan"),
        _share("severity", "severities").alias("average_loss_severity"),
        F.max("largest").alias("maximum_loss_amount"),
        F.sum("conflicts").cast("bigint").alias("label_conflict_loan_count"),
        _share("conflicts", "loans").alias("label_conflict_rate"),
        F.sum("recoveries").cast("bigint").alias("net_recovery_loan_count"),
        F.sum("unknown_amounts").cast("bigint").alias("missing_loss_amount_count"),
        F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("loans"))), F.lit(0)).cast("bigint").alias("missing_received_date_count"),
        F.count("day").cast("bigint").alias("distinct_origination_days"),
        *([] if months is None else _trailing_measures(cube, months)),
    )
    funded = loans.agg(F.countDistinct(cfg.id_col).alias("funded_loan_count"))
    med = exact_median(loans.where(F.col(cfg.label_col)), [], cfg.amount_col, "median_loss_severity")
    return attach_row(attach_row(main, funded), med)


def trailing_bounds(joined: DataFrame, cfg: PortfolioConfig | None = None, months: int = TRAILING_MONTHS) -> DataFrame:
    """Anchor on the newest date; window starts ``months`` and ``2*months`` back."""
    cfg = _cfg(cfg)
    anchor = F.max(cfg.date_col)
    return joined.where(F.col(cfg.date_col).isNotNull()).agg(
        anchor.alias("anchor_date"),
        F.add_months(anchor, -months).alias("last_window_start"),
        F.add_months(anchor, -2 * months).alias("prior_window_start"),
    )


def _trailing_measures(cube: DataFrame, months: int) -> list[Column]:
    """Loans and loss rate in the last and the prior ``months``, from the cube; the bounds are one scalar struct."""
    anchor = F.max("day")
    bounds = cube.agg(F.struct(F.add_months(anchor, -months).alias("last"), F.add_months(anchor, -2 * months).alias("prior")).alias("b")).scalar()
    recent = F.col("day") > bounds["last"]
    earlier = ~recent & (F.col("day") > bounds["prior"])
    out = []
    for inside, name in ((recent, "last"), (earlier, "prior")):
        loans, labelled, losses = (F.sum(F.when(inside, F.col(c)).otherwise(0)) for c in ("loans", "labelled", "losses"))
        out.append(F.coalesce(loans, F.lit(0)).cast("bigint").alias(f"funded_loan_count_{name}_12_months"))
        out.append((losses.cast("double") / F.when(labelled != 0, labelled)).alias(f"loss_rate_{name}_12_months"))
    return out


def trailing_windows(joined: DataFrame, cfg: PortfolioConfig | None = None, months: int = TRAILING_MONTHS) -> DataFrame:
    """Loans and loss rate in the last / prior ``months`` (half-open windows)."""
    cube = stored(date_cube(joined, cfg), "date-cube")
    return cube.agg(*_trailing_measures(cube, months))


def feature_columns(joined: DataFrame, cfg: PortfolioConfig | None = None) -> list[str]:
    """Every column except identifier and outcomes (plan-time only)."""
    cfg = _cfg(cfg)
    return [c for c in joined.columns if c not in cfg.outcome_cols]


def duplicate_vectors(joined: DataFrame, columns: Sequence[str] | None = None, cfg: PortfolioConfig | None = None) -> DataFrame:
    """A12 + A13: duplicate-record groups over the whole feature row (NULLs compare equal).

    Rows meet by a digest of 16 bytes, and only repeated ones by their columns.
    """
    found = repeats(joined, list(columns) if columns is not None else feature_columns(joined, cfg))
    n = F.col("n")
    return found.groups.agg(
        F.count_if(n > 1).cast("bigint").alias("duplicate_feature_vector_groups"),
        F.sum(F.when(n > 1, n)).cast("bigint").alias("duplicate_feature_vector_loan_count"),
        (F.sum(F.when(n > 1, n)).cast("double") / F.lit(float(found.total) if found.total else None)).alias("duplicate_feature_vector_rate"),
        (F.count(F.lit(1)) + F.lit(found.single)).cast("bigint").alias("distinct_feature_vector_count"),
    )


def kpi_record(joined: DataFrame, cfg: PortfolioConfig | None = None, loans: DataFrame | None = None) -> DataFrame:
    """One row holding every KPI as a column (J4 without a cross join).

    ``loans`` (optional) is the outcome table the joined view was built from;
    outcome-only measures read it directly so the plan skips the feature join.
    """
    cfg = _cfg(cfg)
    loans = loans if loans is not None else joined
    base = loan_measures(loans, cfg, TRAILING_MONTHS)
    base = base.withColumn(
        "loss_rate_12_month_change", F.col("loss_rate_last_12_months") - F.col("loss_rate_prior_12_months")
    )
    return attach_row(base, duplicate_vectors(joined, cfg=cfg))


def kpi_rows(metrics: DataFrame, kpis: Sequence[tuple] = KPI_DEFINITIONS) -> DataFrame:
    """Wide one-row record -> one row per KPI via one explode (no unions)."""
    rows = []
    for pos, (group, name, unit, headline) in enumerate(kpis, start=1):
        if unit == "date":
            value, text = F.lit(None).cast("double"), F.date_format(F.col(name), "yyyy-MM-dd")
        else:
            value, text = F.col(name).cast("double"), F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(group).alias("kpi_group"),
                F.lit(name).alias("kpi_name"),
                F.lit(unit).alias("kpi_unit"),
                F.lit(pos).alias("kpi_display_order"),
                F.lit(bool(headline)).alias("is_headline"),
                value.alias("kpi_value"),
                text.alias("kpi_value_text"),
            )
        )
    return metrics.select(F.explode(F.array(*rows)).alias("k")).select("k.*")


def portfolio_kpis(joined: DataFrame, cfg: PortfolioConfig | None = None, loans: DataFrame | None = None) -> DataFrame:
    return kpi_rows(kpi_record(joined, cfg, loans))


def kpi_wide(long: DataFrame, kpis: Sequence[tuple] = KPI_DEFINITIONS) -> DataFrame:
    """Pivot the long table back to one typed row per unit."""
    cols = []
    for _, name, unit, _ in kpis:
        hit = F.col("kpi_name") == name
        if unit == "date":
            v = F.col("kpi_value_text").cast("date")
        elif unit == "count":
            v = F.round(F.col("kpi_value")).cast("bigint")
        elif unit == "amount":
            v = F.col("kpi_value").cast("decimal(18,2)")
        else:
            v = F.col("kpi_value")
        cols.append(F.max(F.when(hit, v)).alias(name))
    return long.agg(*cols)


def headline_kpis(long: DataFrame) -> DataFrame:
    """Headline KPIs in display order."""
    return long.where(F.col("is_headline")).orderBy("kpi_display_order")


# --------------------------------------------------------------------------
# Segmentation
# --------------------------------------------------------------------------


def loan_levels(joined: DataFrame, cfg: PortfolioConfig | None = None, null_label: str = NULL_SEGMENT) -> DataFrame:
    """One row per loan per categorical feature in a single scan."""
    cfg = _cfg(cfg)
    pairs = [
        F.struct(F.lit(f).alias("feature_name"), null_to_segment(f, null_label).alias("segment"))
        for f in cfg.categorical
    ]
    return joined.select(
        cfg.id_col, cfg.label_col, cfg.amount_col, F.explode(F.array(*pairs)).alias("s")
    ).select(cfg.id_col, "s.feature_name", "s.segment", cfg.label_col, cfg.amount_col)


def risk_segmentation(
    joined: DataFrame,
    cfg: PortfolioConfig | None = None,
    min_loans: int = SEGMENT_MIN_LOANS,
    band_pp: float = SEGMENT_BAND_PP,
) -> DataFrame:
    cfg = _cfg(cfg)
    amt, lab = F.col(cfg.amount_col), F.col(cfg.label_col)
    base = joined.select(cfg.id_col, cfg.label_col, cfg.amount_col, *cfg.categorical)
    totals = base.agg(
        F.count(F.lit(1)).alias("portfolio_loan_count"),
        rate_of(lab).alias("portfolio_loss_rate"),
        F.sum(F.when(amt > 0, amt).otherwise(0)).alias("portfolio_positive_loss_amount"),
    )
    positive = F.when(amt > 0, amt)
    seg = (
        loan_levels(base, cfg)
        .groupBy("feature_name", "segment")
        .agg(
            F.count(F.lit(1)).alias("funded_loan_count"),
            F.sum(lab.cast("int")).cast("bigint").alias("loss_loan_count"),
            F.sum(F.when(amt > 0, 1).otherwise(0)).cast("bigint").alias("positive_loss_loan_count"),
            rate_of(lab).alias("observed_loss_rate"),
            F.sum(F.coalesce(amt, F.lit(0))).alias("total_recorded_loss_amount"),
            F.sum(F.when(amt > 0, amt).otherwise(0)).alias("total_positive_loss_amount"),
            mean_of(F.coalesce(amt, F.lit(0))).alias("average_loss_per_funded_loan"),
            mean_of(positive).alias("average_positive_loss_severity"),
            F.max(positive).alias("maximum_positive_loss_amount"),
        )
    )
    long = loan_levels(base, cfg).where(amt > 0)
    med = exact_median(long, ["feature_name", "segment"], cfg.amount_col, "median_positive_loss_severity")
    seg = seg.join(med, ["feature_name", "segment"], "left")
    seg = attach_row(seg, totals)
    diff = (F.col("observed_loss_rate") - F.col("portfolio_loss_rate")) * 100
    n = F.col("funded_loan_count")
    insufficient, high, low, like = SEGMENT_LABELS
    return seg.select(
        "feature_name",
        "segment",
        "funded_loan_count",
        "loss_loan_count",
        "positive_loss_loan_count",
        "observed_loss_rate",
        ratio("funded_loan_count", "portfolio_loan_count").alias("portfolio_loan_share"),
        "total_recorded_loss_amount",
        "total_positive_loss_amount",
        ratio("total_positive_loss_amount", "portfolio_positive_loss_amount").alias("portfolio_positive_loss_share"),
        "average_loss_per_funded_loan",
        "average_positive_loss_severity",
        "median_positive_loss_severity",
        "maximum_positive_loss_amount",
        "portfolio_loss_rate",
        diff.alias("loss_rate_difference_pp"),
        (n >= min_loans).alias("is_material_segment"),
        F.when(n < min_loans, insufficient)
        .when(diff >= band_pp, high)
        .when(diff <= -band_pp, low)
        .otherwise(like)
        .alias("risk_band"),
    )


# --------------------------------------------------------------------------
# Severity bands
# --------------------------------------------------------------------------


def severity_bands(joined: DataFrame, cfg: PortfolioConfig | None = None, bands=SEVERITY_BANDS) -> DataFrame:
    cfg = _cfg(cfg)
    amt = F.col(cfg.amount_col)
    banded = joined.where(amt > 0).select(
        cfg.id_col,
        cfg.amount_col,
        band_order(amt, bands).alias("severity_band_order"),
        band_label(amt, bands).alias("severity_band"),
    )
    totals = banded.agg(
        F.count(F.lit(1)).alias("positive_loss_loan_count"),
        F.sum(amt).alias("portfolio_positive_loss_amount"),
    )
    metrics = banded.groupBy("severity_band_order", "severity_band").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum(amt).alias("total_positive_loss_amount"),
        mean_of(amt).alias("average_positive_loss"),
    )
    med = exact_median(banded, ["severity_band_order", "severity_band"], cfg.amount_col, "median_positive_loss")
    metrics = metrics.join(med, ["severity_band_order", "severity_band"], "left")
    m = attach_row(metrics, totals)
    return m.select(
        "severity_band",
        "severity_band_order",
        "loan_count",
        ratio("loan_count", "positive_loss_loan_count").alias("positive_loss_loan_share"),
        "total_positive_loss_amount",
        ratio("total_positive_loss_amount", "portfolio_positive_loss_amount").alias("positive_loss_amount_share"),
        "average_positive_loss",
        "median_positive_loss",
    )
