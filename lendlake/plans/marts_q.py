"""Staging and portfolio-mart queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlake.config import KPI_DEFINITIONS, SEVERITY_BANDS
from lendlake.operators import marts
from lendlake.plans.registry import portfolio, query
from lendlake.plans.sqlbits import rate
from lendlake.sources.fixture import FEATURE_COLUMNS

# ---------------------------------------------------------------- staging


@query("stg_loans", "SELECT * FROM stg_loans")
def q_stg_loans(spark, sf_dir):
    """Typed outcome table."""
    return portfolio(spark, sf_dir).loans


@query("stg_loan_features", "SELECT * FROM stg_loan_features")
def q_stg_loan_features(spark, sf_dir):
    """Typed feature table (pattern cast of the numeric columns)."""
    return portfolio(spark, sf_dir).features


@query("loans_joined", "SELECT * FROM loans_joined")
def q_loans_joined(spark, sf_dir):
    """J1 + P2: outcomes LEFT JOIN features."""
    return portfolio(spark, sf_dir).joined


# ---------------------------------------------------------------- cohorts

def _cohort_sql(key: str) -> str:
    """CTE ``cohorts``: sums by day rolled up to ``key`` (a function of d), beside the distinct loans and the median of each key."""
    return f"""
days AS (
    SELECT received_date AS d, count(*) AS loans, count(is_loss) AS known, count(*) FILTER (is_loss) AS lost,
        sum(loss_amount) AS recorded, sum(loss_amount) FILTER (loss_amount > 0) AS above, max(loss_amount) AS largest,
        sum(loss_amount) FILTER (is_loss) AS severity, count(loss_amount) FILTER (is_loss) AS severities
    FROM loans_joined WHERE received_date IS NOT NULL GROUP BY d
),
sums AS (
    SELECT {key} AS k, sum(loans) AS n, sum(known) AS known, sum(lost) AS lost, coalesce(sum(recorded), 0)::DOUBLE AS recorded,
        coalesce(sum(above), 0)::DOUBLE AS above, max(largest) AS largest, sum(severity)::DOUBLE / sum(severities) AS severity
    FROM days GROUP BY k
),
ids AS (
    SELECT k, count(*) AS funded FROM (SELECT DISTINCT {key} AS k, loan_id FROM (SELECT received_date AS d, loan_id FROM loans_joined))
    WHERE k IS NOT NULL AND loan_id IS NOT NULL GROUP BY k
),
middles AS (
    SELECT {key} AS k, quantile_cont(loss_amount, 0.5) AS middle
    FROM (SELECT received_date AS d, loss_amount FROM loans_joined WHERE is_loss) GROUP BY k
),
cohorts AS (
    SELECT k, coalesce(funded, 0) AS funded_loan_count, lost::BIGINT AS loss_loan_count, lost / known AS observed_loss_rate,
        recorded AS total_recorded_loss_amount, above AS total_positive_loss_amount, recorded / n AS average_loss_per_funded_loan,
        severity AS average_loss_severity, middle::DOUBLE AS median_loss_severity, largest::DOUBLE AS maximum_loss_amount
    FROM sums LEFT JOIN ids USING (k) LEFT JOIN middles USING (k)
)"""


@query("portfolio_yearly", _cohort_sql("year(d)::INT") + """
SELECT k AS origination_year, * EXCLUDE (k) FROM cohorts
""")
def q_portfolio_yearly(spark, sf_dir):
    """Yearly cohort mart."""
    p = portfolio(spark, sf_dir)
    return marts.portfolio_yearly(p.loans, p.cfg)


@query("portfolio_quarterly", _cohort_sql("date_trunc('quarter', d)::DATE") + """
SELECT strftime(k, '%Y') || '-Q' || quarter(k) AS origination_year_quarter_key, year(k)::INT AS origination_year,
    quarter(k)::INT AS origination_quarter_number, 'Q' || quarter(k) AS origination_quarter_name, k AS origination_quarter_start,
    * EXCLUDE (k, maximum_loss_amount)
FROM cohorts
""")
def q_portfolio_quarterly(spark, sf_dir):
    """A10: quarterly cohort mart."""
    p = portfolio(spark, sf_dir)
    return marts.portfolio_quarterly(p.loans, p.cfg)


# ---------------------------------------------------------------- KPI record

# The whole record as one row.  Every loan carries the newest date and, over its
# feature vector, how many loans share it and whether it is the first of them;
# from these flags a single aggregate with filters yields all measures.
_RECORD_SQL = f"""
flagged AS (
    SELECT *, loss_amount > 0 AS lossy, max(received_date) OVER () AS newest,
        count(*) OVER same AS sharing, row_number() OVER same AS nth
    FROM loans_joined
    WINDOW same AS (PARTITION BY {", ".join(FEATURE_COLUMNS)})
),
timed AS (
    SELECT *, CASE
        WHEN received_date > newest - INTERVAL 12 MONTH THEN 'recent'
        WHEN received_date > newest - INTERVAL 24 MONTH THEN 'earlier' END AS period
    FROM flagged
),
record AS (
    SELECT
        count(DISTINCT loan_id) AS funded_loan_count,
        min(received_date) AS first_origination_date,
        any_value(newest) AS last_origination_date,
        CAST(any_value(newest) - min(received_date) AS BIGINT) AS origination_window_days,
        count(DISTINCT received_date) AS distinct_origination_days,
        count(*) FILTER (is_loss) AS loss_loan_count,
        count(*) FILTER (NOT is_loss) AS non_loss_loan_count,
        count(*) FILTER (is_loss) / nullif(count(is_loss), 0) AS portfolio_loss_rate,
        sum(loss_amount) AS total_recorded_loss_amount,
        coalesce(sum(loss_amount) FILTER (lossy), 0) AS total_positive_loss_amount,
        coalesce(sum(loss_amount) FILTER (loss_amount < 0), 0) AS total_net_recovery_amount,
        CAST(sum(loss_amount) AS DOUBLE) / count(*) AS average_loss_per_funded_loan,
        CAST(sum(loss_amount) FILTER (is_loss) AS DOUBLE) / count(loss_amount) FILTER (is_loss) AS average_loss_severity,
        quantile_cont(loss_amount, 0.5) FILTER (is_loss) AS median_loss_severity,
        max(loss_amount) AS maximum_loss_amount,
        count(*) FILTER (lossy <> is_loss) AS label_conflict_loan_count,
        count(*) FILTER (lossy <> is_loss) / count(*) AS label_conflict_rate,
        count(*) FILTER (loss_amount < 0) AS net_recovery_loan_count,
        count(*) - count(loss_amount) AS missing_loss_amount_count,
        count(*) - count(received_date) AS missing_received_date_count,
        count(*) FILTER (period = 'recent') AS funded_loan_count_last_12_months,
        count(*) FILTER (period = 'recent' AND is_loss) / nullif(count(is_loss) FILTER (period = 'recent'), 0)
            AS loss_rate_last_12_months,
        count(*) FILTER (period = 'earlier') AS funded_loan_count_prior_12_months,
        count(*) FILTER (period = 'earlier' AND is_loss) / nullif(count(is_loss) FILTER (period = 'earlier'), 0)
            AS loss_rate_prior_12_months,
        loss_rate_last_12_months - loss_rate_prior_12_months AS loss_rate_12_month_change,
        count(*) FILTER (sharing > 1 AND nth = 1) AS duplicate_feature_vector_groups,
        (sum(1) FILTER (sharing > 1))::BIGINT AS duplicate_feature_vector_loan_count,
        (sum(1) FILTER (sharing > 1)) / count(*) AS duplicate_feature_vector_rate,
        count(*) FILTER (nth = 1) AS distinct_feature_vector_count
    FROM timed
)"""


def _kpi_structs(only_headline: bool = False) -> str:
    """One row per KPI: unnest of a list of structs built from the record."""
    structs = []
    for pos, (group, name, unit, headline) in enumerate(KPI_DEFINITIONS, start=1):
        if only_headline and not headline:
            continue
        date = unit == "date"
        structs.append(
            f"{{kpi_group: '{group}', kpi_name: '{name}', kpi_unit: '{unit}', kpi_display_order: {pos}, "
            f"is_headline: {str(bool(headline)).lower()}, kpi_value: {'NULL' if date else name}::DOUBLE, "
            f"kpi_value_text: {f'{name}::DATE::VARCHAR' if date else 'NULL::VARCHAR'}}}"
        )
    return "SELECT unnest([" + ",\n".join(structs) + "], recursive := true) FROM record"


_WIDE_TYPES = {"date": "DATE", "count": "BIGINT", "amount": "DECIMAL(18,2)::DOUBLE", "rate": "DOUBLE", "rate_change": "DOUBLE"}


def _record_typed() -> str:
    return "SELECT " + ", ".join(f"{name}::{_WIDE_TYPES[unit]} AS {name}" for _, name, unit, _ in KPI_DEFINITIONS) + " FROM record"


@query("portfolio_kpis_long", _RECORD_SQL + "\n" + _kpi_structs())
def q_portfolio_kpis_long(spark, sf_dir):
    """The long KPI mart (29 rows)."""
    p = portfolio(spark, sf_dir)
    return marts.portfolio_kpis(p.joined, p.cfg, p.loans)


@query("portfolio_kpis_wide", _RECORD_SQL + "\n" + _record_typed())
def q_portfolio_kpis_wide(spark, sf_dir):
    """One typed row pivoted from the long mart."""
    p = portfolio(spark, sf_dir)
    return marts.kpi_wide(marts.portfolio_kpis(p.joined, p.cfg, p.loans))


@query("headline_kpis", _RECORD_SQL + "\n" + _kpi_structs(only_headline=True))
def q_headline_kpis(spark, sf_dir):
    """Headline KPIs (ordered by display order)."""
    p = portfolio(spark, sf_dir)
    return marts.headline_kpis(marts.portfolio_kpis(p.joined, p.cfg, p.loans))


@query(
    "trailing_windows",
    """
newest AS (SELECT received_date AS d FROM loans_joined ORDER BY d DESC NULLS LAST LIMIT 1),
months AS (
    SELECT is_loss, CASE WHEN received_date > d - INTERVAL 1 YEAR THEN 0 ELSE 1 END AS years_back, d
    FROM newest LEFT JOIN loans_joined ON received_date > d - INTERVAL 2 YEAR
)
SELECT count(*) FILTER (years_back = 0) AS funded_loan_count_last_12_months,
    avg(is_loss::INT) FILTER (years_back = 0) AS loss_rate_last_12_months,
    count(*) FILTER (years_back = 1) AS funded_loan_count_prior_12_months,
    avg(is_loss::INT) FILTER (years_back = 1) AS loss_rate_prior_12_months,
    d AS anchor_date, (d - INTERVAL 1 YEAR)::DATE AS last_window_start, (d - INTERVAL 2 YEAR)::DATE AS prior_window_start
FROM months GROUP BY d
""",
)
def q_trailing_windows(spark, sf_dir):
    """A11 + F5: last / prior 12-month windows anchored on the newest date."""
    p = portfolio(spark, sf_dir)
    rw = marts.trailing_windows(p.loans, p.cfg)
    return marts.attach_row(rw, marts.trailing_bounds(p.loans, p.cfg))


@query(
    "duplicate_vectors",
    f"""
shared AS (
    SELECT count(*) OVER v AS n, row_number() OVER v AS nth FROM loans_joined
    WINDOW v AS (PARTITION BY {", ".join(FEATURE_COLUMNS)})
)
SELECT count(*) FILTER (n > 1 AND nth = 1) AS duplicate_feature_vector_groups,
    (sum(1) FILTER (n > 1))::BIGINT AS duplicate_feature_vector_loan_count,
    (sum(1) FILTER (n > 1)) / count(*) AS duplicate_feature_vector_rate,
    count(*) FILTER (nth = 1) AS distinct_feature_vector_count,
    max(n) AS largest_group
FROM shared
""",
)
def q_duplicate_vectors(spark, sf_dir):
    """A12 + A13 on the whole feature vector (plus the largest group size)."""
    p = portfolio(spark, sf_dir)
    dup = marts.duplicate_vectors(p.joined)
    largest = p.joined.groupBy(*FEATURE_COLUMNS).count().agg(F.max("count").cast("bigint").alias("largest_group"))
    return marts.attach_row(dup, largest)


# ---------------------------------------------------------------- segmentation

_SEG_FEATURES = ["feat_001", "feat_003", "feat_004", "feat_015", "feat_041"]


@query(
    "risk_segmentation",
    f"""
cube AS (
    -- One pass: a grouping set per feature, and the empty one for the portfolio.
    SELECT {", ".join(f"{f}::VARCHAR AS {f}" for f in _SEG_FEATURES)},
        list_position([{", ".join(f"grouping({f})" for f in _SEG_FEATURES)}], 0) AS facet,
        count(*) AS n, count(*) FILTER (is_loss) AS losses, count(is_loss) AS known,
        count(*) FILTER (loss_amount > 0) AS hits, sum(loss_amount) AS total,
        coalesce(sum(loss_amount) FILTER (loss_amount > 0), 0) AS positive,
        quantile_cont(loss_amount, 0.5) FILTER (loss_amount > 0) AS middle,
        max(loss_amount) FILTER (loss_amount > 0) AS top
    FROM loans_joined GROUP BY GROUPING SETS ({", ".join(f"({f})" for f in _SEG_FEATURES)}, ())
),
beside AS (
    SELECT *, max(n) OVER () AS all_n, max(losses / known) FILTER (facet IS NULL) OVER () AS all_rate,
        max(positive) FILTER (facet IS NULL) OVER () AS all_positive
    FROM cube
),
judged AS (SELECT *, (losses / known - all_rate) * 100 AS pp FROM beside WHERE facet IS NOT NULL)
SELECT [{", ".join(f"'{f}'" for f in _SEG_FEATURES)}][facet] AS feature_name,
    coalesce([{", ".join(_SEG_FEATURES)}][facet], '__NULL__') AS segment,
    n AS funded_loan_count, losses AS loss_loan_count, hits AS positive_loss_loan_count,
    losses / known AS observed_loss_rate, n / all_n AS portfolio_loan_share,
    coalesce(total, 0)::DOUBLE AS total_recorded_loss_amount, positive::DOUBLE AS total_positive_loss_amount,
    positive::DOUBLE / all_positive::DOUBLE AS portfolio_positive_loss_share,
    coalesce(total, 0)::DOUBLE / n AS average_loss_per_funded_loan,
    CASE WHEN hits > 0 THEN positive::DOUBLE / hits END AS average_positive_loss_severity,
    middle::DOUBLE AS median_positive_loss_severity, top::DOUBLE AS maximum_positive_loss_amount,
    all_rate AS portfolio_loss_rate, pp AS loss_rate_difference_pp, n >= 100 AS is_material_segment,
    CASE WHEN n < 100 THEN 'Insufficient sample' WHEN pp >= 5 THEN 'High risk' WHEN pp <= -5 THEN 'Low risk' ELSE 'Portfolio-like' END AS risk_band
FROM judged
""",
)
def q_risk_segmentation(spark, sf_dir):
    """Risk segmentation mart."""
    p = portfolio(spark, sf_dir)
    return marts.risk_segmentation(p.joined, p.cfg)


# ---------------------------------------------------------------- bands


_BAND_EDGES = [upper for upper, _ in SEVERITY_BANDS if upper is not None]
_BAND_NAMES = ", ".join(repr(label) for _, label in SEVERITY_BANDS)


@query(
    "severity_bands",
    f"""
SELECT [{_BAND_NAMES}][k] AS severity_band, k AS severity_band_order, count(*) AS loan_count,
    count(*) / sum(count(*)) OVER () AS positive_loss_loan_share,
    sum(loss_amount)::DOUBLE AS total_positive_loss_amount,
    sum(loss_amount)::DOUBLE / (sum(sum(loss_amount)) OVER ())::DOUBLE AS positive_loss_amount_share,
    sum(loss_amount)::DOUBLE / count(*) AS average_positive_loss,
    quantile_cont(loss_amount, 0.5)::DOUBLE AS median_positive_loss
FROM (
    SELECT loss_amount, (1 + len(list_filter({_BAND_EDGES}, lambda edge: loss_amount >= edge)))::INT AS k
    FROM loans_joined WHERE loss_amount > 0)
GROUP BY k
""",
)
def q_severity_bands(spark, sf_dir):
    """Loss-severity bands."""
    p = portfolio(spark, sf_dir)
    return marts.severity_bands(p.loans, p.cfg)


# ---------------------------------------------------------------- typed-load diagnostics

# Every feature column: numbers as staged, flags as flags, texts as themselves or as whole numbers (which fail).
_CASTS = {c: "DOUBLE" for c in FEATURE_COLUMNS}
_CASTS |= {"feat_001": "INTEGER", "feat_003": "VARCHAR", "feat_004": "BOOLEAN", "feat_015": "BOOLEAN", "feat_041": "INTEGER"}


@query(
    "cast_failures",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS BIGINT) "
        f"AS failed_casts FROM raw_features"
        for c, t in _CASTS.items()
    ),
)
def q_cast_failures(spark, sf_dir):
    """S3 variant: non-NULL raw values that fail a typed cast (try_cast), per column."""
    from lendlake.sources.staging import cast_failures

    p = portfolio(spark, sf_dir)
    return cast_failures(p.raw_features, {c: ("STRING" if t == "VARCHAR" else t) for c, t in _CASTS.items()})


@query(
    "date_filter",
    f"""
SELECT CAST(extract(year FROM received_date) AS INTEGER) AS origination_year, count(*) AS loans,
    {rate('is_loss')} AS loss_rate
FROM loans_joined WHERE received_date >= DATE '2000-01-01' GROUP BY 1
""",
)
def q_date_filter(spark, sf_dir):
    """Loans received on or after a date (filter pushed to the Parquet scan)."""
    from lendlake.functions import rate_of

    p = portfolio(spark, sf_dir)
    recent = p.loans.where(F.col("received_date") >= F.lit("2000-01-01").cast("date"))
    return recent.groupBy(F.year("received_date").cast("int").alias("origination_year")).agg(
        F.count(F.lit(1)).alias("loans"), rate_of("is_loss").alias("loss_rate"))
