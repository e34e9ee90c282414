"""Profiling and outcome-diagnostic queries with SQL twins.

Moment statistics computed by different algorithms (std, skewness, corr)
agree to ~1e-12 relative; both sides round them (4 decimals for values on
the data scale, 8-9 for unit-free ratios) so the results hash identically.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.operators import features as fx
from lendlake.operators import profiling as pf
from lendlake.plans.features_q import SEVERITY_SQL, TRAINING_SQL
from lendlake.plans.registry import portfolio, query
from lendlake.plans.sqlbits import mean, rate
from lendlake.sources.fixture import FEATURE_COLUMNS

NUM_COLS = [c for c in FEATURE_COLUMNS if c not in ("feat_001", "feat_003", "feat_004", "feat_015", "feat_041")]
STD_COLS = pf.feature_groups(NUM_COLS)["std"]
ALL_COLS = ["loan_id", "received_date", "is_loss", "loss_amount", "feat_001", "feat_003", "feat_004", "feat_015",
            "feat_041", *NUM_COLS]


def _r(c, d):
    return F.round(F.col(c), d).alias(c)


def _u(parts):
    return "\nUNION ALL\n".join(parts)


@query(
    "profile_nulls",
    "p AS (" + _u(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS null_pct FROM loans_joined" for c in ALL_COLS
    ) + ")\nSELECT column_name, null_count, CAST(null_pct AS DOUBLE) AS null_pct FROM p WHERE null_count > 0",
)
def q_profile_nulls(spark, sf_dir):
    """Columns with NULLs, count and %."""
    p = portfolio(spark, sf_dir)
    return pf.null_profile(p.joined.select(*ALL_COLS))


@query(
    "profile_columns",
    "p AS (" + _u(
        f"SELECT '{c}' AS column_name, regexp_extract('{c}', '_(min|max|mean|sum|trend|cv|std)$', 1) AS column_family, "
        f"count({c}) AS count, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
        f"min({c}) AS min, max({c}) AS max, round(median({c}), 6) AS median, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std FROM loans_joined" for c in NUM_COLS
    ) + ")\nSELECT * FROM p",
)
def q_profile_columns(spark, sf_dir):
    """Per-column count, nulls, min, max, median, mean, std (+ suffix family)."""
    p = portfolio(spark, sf_dir)
    out = pf.column_profile(p.joined, NUM_COLS)
    return out.select("column_name", "column_family", "count", "nulls", "min", "max", _r("median", 6), _r("mean", 4), _r("std", 4))


CATEGORIES = ["feat_001", "feat_003", "feat_004", "feat_015", "feat_041"]


def _each(make):
    """One report per category, stacked."""
    parts = [make(c).select(F.lit(c).alias("column_name"), "*") for c in CATEGORIES]
    return reduce(DataFrame.unionByName, parts)


@query(
    "profile_categories",
    _u(
        f"SELECT '{c}' AS column_name, coalesce({c}::VARCHAR, 'Missing') AS level, count(*) AS count, "
        f"count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM loans_joined GROUP BY 2" for c in CATEGORIES
    ),
)
def q_profile_categories(spark, sf_dir):
    """Level counts and % of every category, missing kept."""
    joined = portfolio(spark, sf_dir).joined
    return _each(lambda c: pf.category_summary(joined, c, include_missing=True))


@query(
    "profile_by_level",
    _u(
        f"SELECT '{c}' AS column_name, coalesce({c}::VARCHAR, 'Missing') AS level, count(*) AS loans, "
        f"CAST(sum(CAST(is_loss AS INTEGER)) AS BIGINT) AS losses, {rate('is_loss')} AS loss_rate, "
        f"{rate('is_loss')} * 100 AS loss_rate_pct, {mean('loss_amount')} AS mean_loss_amount FROM loans_joined GROUP BY 2"
        for c in CATEGORIES
    ),
)
def q_profile_by_level(spark, sf_dir):
    """Loss outcome by level of every category."""
    joined = portfolio(spark, sf_dir).joined
    return _each(lambda c: pf.loss_by_level(joined, c))


@query(
    "profile_median_by_level",
    f"sev AS ({SEVERITY_SQL})\n" + _u(
        f"(SELECT '{c}' AS column_name, {c}::VARCHAR AS level, count(*) AS loans, round(median(loss_amount), 6) AS median_amount "
        f"FROM sev WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY loans DESC, {c} LIMIT 10)" for c in CATEGORIES
    ),
)
def q_profile_median_by_level(spark, sf_dir):
    """Median loss of the 10 most frequent levels of every category (a top-k report)."""
    p = portfolio(spark, sf_dir)
    sev = fx.severity_set(p.joined, p.cfg)
    return _each(
        lambda c: pf.median_by_level(sev, c, "loss_amount").select(F.col(c).cast("string").alias("level"), "loans", _r("median_amount", 6))
    )


@query(
    "profile_amount_by_label",
    f"""
SELECT is_loss, count(*) AS rows, count(*) FILTER (WHERE loss_amount IS NULL) AS missing,
    CAST(min(loss_amount) AS DOUBLE) AS min, round(median(CAST(loss_amount AS DOUBLE)), 6) AS median,
    {mean('loss_amount')} AS mean, CAST(max(loss_amount) AS DOUBLE) AS max
FROM loans_joined GROUP BY is_loss
""",
)
def q_profile_amount_by_label(spark, sf_dir):
    """Loss-amount profile by label."""
    out = pf.amount_profile_by_label(portfolio(spark, sf_dir).joined)
    return out.select("is_loss", "rows", "missing", "min", _r("median", 6), "mean", "max")


@query(
    "profile_crosstab",
    """
g AS (
    SELECT CASE WHEN loss_amount IS NULL THEN 'missing' WHEN loss_amount > 0 THEN 'positive'
        WHEN loss_amount = 0 THEN 'zero' ELSE 'negative' END AS amount_sign,
        count(*) FILTER (WHERE NOT is_loss) AS label_false, count(*) FILTER (WHERE is_loss) AS label_true
    FROM loans_joined GROUP BY 1
)
SELECT *, CASE WHEN label_true > label_false THEN 'label_true' WHEN label_true < label_false THEN 'label_false'
    ELSE 'tie' END AS higher_count, label_true - label_false AS difference FROM g
""",
)
def q_profile_crosstab(spark, sf_dir):
    """Sign group x label crosstab."""
    return pf.sign_label_crosstab(portfolio(spark, sf_dir).joined)


@query(
    "profile_repeats",
    """
SELECT received_date, CAST(loss_amount AS DOUBLE) AS loss_amount, count(*) AS rows, min(loan_id) AS first_id, max(loan_id) AS last_id
FROM loans_joined WHERE is_loss AND loss_amount <= 0 GROUP BY received_date, loss_amount HAVING count(*) > 1
""",
)
def q_profile_repeats(spark, sf_dir):
    """Repeated (date, amount) combinations of flagged rows without a positive amount."""
    odd = pf.flagged_not_positive(portfolio(spark, sf_dir).loans)
    return pf.repeated_patterns(odd, ["received_date", "loss_amount"])


@query(
    "repeated_members",
    """
counted AS (
    SELECT received_date, loss_amount, loan_id, count(*) OVER (PARTITION BY received_date, loss_amount) AS rows
    FROM loans_joined WHERE is_loss AND loss_amount <= 0)
SELECT received_date, loss_amount::DOUBLE AS loss_amount, loan_id, rows FROM counted WHERE rows > 1
""",
)
def q_repeated_members(spark, sf_dir):
    """The loans of each repeated combination, one row per member."""
    odd = pf.flagged_not_positive(portfolio(spark, sf_dir).loans)
    return pf.repeated_members(odd, ["received_date", "loss_amount"])


@query(
    "profile_shape",
    "SELECT count(*) AS rows, " + str(len(ALL_COLS)) + " AS columns, CAST(sum("
    + " + ".join(f"({c} IS NULL)::INT" for c in ALL_COLS) + ") AS BIGINT) AS missing_cells, 1 AS columns_date, 1 AS columns_decimal, "
    "3 AS columns_boolean, 4 AS columns_string, " + str(len(ALL_COLS) - 9) + " AS columns_double FROM loans_joined",
)
def q_profile_shape(spark, sf_dir):
    """Rows, columns by type and missing cells."""
    return pf.missing_cells(portfolio(spark, sf_dir).joined.select(*ALL_COLS))


@query(
    "rows_with_nulls",
    "SELECT loan_id, " + ", ".join(FEATURE_COLUMNS) + " FROM loans_joined WHERE " + " OR ".join(f"{c} IS NULL" for c in FEATURE_COLUMNS),
)
def q_rows_with_nulls(spark, sf_dir):
    """P10: the rows with any predictor missing."""
    return pf.rows_with_nulls(portfolio(spark, sf_dir).joined, FEATURE_COLUMNS)


@query(
    "profile_outcome_shares",
    """
SELECT count(*) FILTER (WHERE is_loss) / count(*) AS share_label_true,
    count(*) FILTER (WHERE NOT is_loss) / count(*) AS share_label_false,
    count(*) FILTER (WHERE loss_amount > 0) / count(*) AS share_positive,
    count(*) FILTER (WHERE loss_amount = 0) / count(*) AS share_zero,
    count(*) FILTER (WHERE loss_amount < 0) / count(*) AS share_negative,
    count(*) FILTER (WHERE loss_amount IS NULL) / count(*) AS share_missing
FROM loans_joined
""",
)
def q_profile_outcome_shares(spark, sf_dir):
    """Share of rows per label and amount sign."""
    return pf.outcome_shares(portfolio(spark, sf_dir).loans)


_QS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


@query(
    "profile_quantiles",
    "SELECT is_loss, count(loss_amount) AS count, round(avg(CAST(loss_amount AS DOUBLE)), 4) AS mean, "
    "round(stddev_samp(CAST(loss_amount AS DOUBLE)), 4) AS std, CAST(min(loss_amount) AS DOUBLE) AS min, "
    + ", ".join(f"round(quantile_cont(CAST(loss_amount AS DOUBLE), {q}), 6) AS q{int(round(q * 100)):02d}" for q in _QS)
    + ", CAST(max(loss_amount) AS DOUBLE) AS max FROM loans_joined GROUP BY is_loss",
)
def q_profile_quantiles(spark, sf_dir):
    """Describe + quantile list of the loss amount by label."""
    d = pf.describe(portfolio(spark, sf_dir).joined, "loss_amount", by="is_loss", quantiles=_QS)
    qn = [f"q{int(round(q * 100)):02d}" for q in _QS]
    return d.select("is_loss", "count", _r("mean", 4), _r("std", 4), "min", *[_r(c, 6) for c in qn], "max")


@query(
    "profile_skew",
    f"""
sev AS ({SEVERITY_SQL})
SELECT round(skewness(loss_amount), 8) AS skew_raw, round(skewness(ln(1 + loss_amount)), 8) AS skew_log1p FROM sev
""",
)
def q_profile_skew(spark, sf_dir):
    """Bias-corrected skewness of the severity target, raw and log1p."""
    p = portfolio(spark, sf_dir)
    out = pf.skewness_profile(fx.severity_set(p.joined, p.cfg), "loss_amount")
    return out.select(_r("skew_raw", 8), _r("skew_log1p", 8))


SEV_NUM = NUM_COLS


@query(
    "profile_correlation",
    f"""
sev AS ({SEVERITY_SQL}),
c AS ({_u(f"SELECT '{c}' AS column_name, corr({c}, loss_amount) AS correlation FROM sev" for c in SEV_NUM)})
SELECT column_name, round(correlation, 9) AS correlation, round(abs(correlation), 9) AS abs_correlation FROM c
""",
)
def q_profile_correlation(spark, sf_dir):
    """Correlation of each numeric column with the severity target."""
    p = portfolio(spark, sf_dir)
    out = pf.correlation_with_target(fx.severity_set(p.joined, p.cfg), SEV_NUM, "loss_amount")
    return out.select("column_name", _r("correlation", 9), _r("abs_correlation", 9))


@query(
    "profile_null_patterns",
    f"""
SELECT count(*) AS rows,
    count(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in FEATURE_COLUMNS)}) AS rows_any_null,
    count(*) FILTER (WHERE {' AND '.join(c + ' IS NULL' for c in FEATURE_COLUMNS)}) AS rows_all_null
FROM loans_joined
""",
)
def q_profile_null_patterns(spark, sf_dir):
    """Rows with any / all of the predictors missing."""
    return pf.null_patterns(portfolio(spark, sf_dir).joined, FEATURE_COLUMNS)


@query(
    "profile_missing_flag",
    f"""
SELECT ({' OR '.join(c + ' IS NULL' for c in STD_COLS)}) AS any_missing, count(*) AS loans, count(*) FILTER (is_loss) AS losses,
    {rate('is_loss')} AS loss_rate, {rate('is_loss')} * 100 AS loss_rate_pct,
    {mean('loss_amount')} AS mean_loss_amount, round(median(CAST(loss_amount AS DOUBLE)), 6) AS median_loss_amount,
    min(received_date) AS first_date, max(received_date) AS last_date
FROM loans_joined GROUP BY 1
""",
)
def q_profile_missing_flag(spark, sf_dir):
    """Outcome by the "any column of a family missing" flag (the std family)."""
    out = pf.missing_flag_outcome(portfolio(spark, sf_dir).joined, STD_COLS, "is_loss", "loss_amount", "received_date")
    return out.withColumn("median_loss_amount", F.round("median_loss_amount", 6))


_CANDIDATES = [995.0, 999.0, 999999999.0]


@query(
    "profile_sentinels",
    "f AS (" + _u(
        f"SELECT '{c}' AS column_name, {v} AS value, CAST(count(*) FILTER (WHERE CAST({c} AS DOUBLE) = {v}) AS BIGINT) AS rows, "
        f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) = {v}) * 100.0 / count(*) AS pct FROM loans_joined"
        for c in NUM_COLS for v in _CANDIDATES
    ) + ")\nSELECT column_name, CAST(value AS DOUBLE) AS value, rows, CAST(pct AS DOUBLE) AS pct FROM f WHERE rows > 0",
)
def q_profile_sentinels(spark, sf_dir):
    """Candidate sentinel codes per numeric column."""
    return pf.value_frequency(portfolio(spark, sf_dir).joined, NUM_COLS, _CANDIDATES)


@query(
    "profile_max_mass",
    "m AS (" + _u(
        f"SELECT '{c}' AS column_name, max({c}) AS max_value, "
        f"CAST(count(*) FILTER (WHERE {c} = (SELECT max({c}) FROM loans_joined)) AS BIGINT) AS rows_at_max, "
        f"count(*) FILTER (WHERE {c} = (SELECT max({c}) FROM loans_joined)) * 100.0 / count(*) AS pct_at_max FROM loans_joined"
        for c in NUM_COLS
    ) + ")\nSELECT column_name, max_value, rows_at_max, CAST(pct_at_max AS DOUBLE) AS pct_at_max FROM m",
)
def q_profile_max_mass(spark, sf_dir):
    """Mass at each column's maximum."""
    return pf.mass_at_max(portfolio(spark, sf_dir).joined, NUM_COLS)


@query(
    "profile_mean_mass",
    "m AS (" + _u(
        f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, "
        f"CAST(count(*) FILTER (WHERE {c} = 0.0) AS BIGINT) AS rows_at_value, "
        f"count(*) FILTER (WHERE {c} = 0.0) * 100.0 / count(*) AS pct_at_value FROM loans_joined"
        for c in NUM_COLS
    ) + ")\nSELECT column_name, mean, rows_at_value, CAST(pct_at_value AS DOUBLE) AS pct_at_value FROM m",
)
def q_profile_mean_mass(spark, sf_dir):
    """Column mean and share of rows at zero (explicit reference value)."""
    out = pf.mean_and_mass_at(portfolio(spark, sf_dir).joined, NUM_COLS, 0.0)
    return out.select("column_name", _r("mean", 4), "rows_at_value", "pct_at_value")


_MV_COLS = FEATURE_COLUMNS


@query(
    "profile_missing_vs_outcome",
    "m AS (" + _u(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_rows, "
        f"CAST(sum(CASE WHEN {c} IS NULL THEN CAST(is_loss AS INTEGER) END) AS DOUBLE) / nullif(count(*) FILTER (WHERE {c} IS NULL), 0) AS loss_rate_missing, "
        f"CAST(sum(CASE WHEN {c} IS NOT NULL THEN CAST(is_loss AS INTEGER) END) AS DOUBLE) / nullif(count(*) FILTER (WHERE {c} IS NOT NULL AND is_loss IS NOT NULL), 0) AS loss_rate_present "
        f"FROM loans_joined" for c in _MV_COLS
    ) + ")\nSELECT *, loss_rate_missing - loss_rate_present AS difference FROM m WHERE missing_rows > 0",
)
def q_profile_missing_vs_outcome(spark, sf_dir):
    """Loss rate when missing vs present, per column."""
    return pf.missing_vs_outcome(portfolio(spark, sf_dir).joined, _MV_COLS)


_MY_COLS = FEATURE_COLUMNS


@query(
    "profile_missing_by_year",
    "SELECT CAST(extract(year FROM received_date) AS INTEGER) AS year, count(*) AS rows, "
    + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}_missing_pct" for c in _MY_COLS)
    + " FROM loans_joined GROUP BY 1",
)
def q_profile_missing_by_year(spark, sf_dir):
    """% missing by origination year."""
    return pf.missing_by_year(portfolio(spark, sf_dir).joined, _MY_COLS)


@query(
    "key_uniqueness",
    "SELECT count(*) AS rows, count(DISTINCT loan_id) AS distinct_keys, count(*) = count(DISTINCT loan_id) AS is_unique FROM loans_joined",
)
def q_key_uniqueness(spark, sf_dir):
    """Uniqueness of the loan key."""
    return pf.key_uniqueness(portfolio(spark, sf_dir).loans, "loan_id")


@query(
    "date_range",
    "SELECT min(received_date) AS first_date, max(received_date) AS last_date, count(DISTINCT received_date) AS distinct_dates FROM loans_joined",
)
def q_date_range(spark, sf_dir):
    """Date range and distinct dates."""
    return pf.date_range(portfolio(spark, sf_dir).loans, "received_date")


@query(
    "label_conflicts",
    """
SELECT loan_id, is_loss, CAST(loss_amount AS DOUBLE) AS loss_amount,
    CASE WHEN is_loss AND loss_amount <= 0 THEN 'flagged_not_positive' ELSE 'unflagged_positive' END AS conflict_kind
FROM loans_joined WHERE (is_loss AND loss_amount <= 0) OR (NOT is_loss AND loss_amount > 0)
""",
)
def q_label_conflicts(spark, sf_dir):
    """The conflicting rows of both kinds."""
    return pf.label_conflicts(portfolio(spark, sf_dir).loans)


@query(
    "conflict_summary",
    """
SELECT count(*) FILTER (WHERE is_loss AND loss_amount <= 0) AS flagged_not_positive,
    count(*) FILTER (WHERE NOT is_loss AND loss_amount > 0) AS unflagged_positive,
    count(*) FILTER (WHERE is_loss AND loss_amount <= 0) / count(*) AS flagged_not_positive_share,
    count(*) FILTER (WHERE NOT is_loss AND loss_amount > 0) / count(*) AS unflagged_positive_share
FROM loans_joined
""",
)
def q_conflict_summary(spark, sf_dir):
    """Conflict counts and shares."""
    return pf.conflict_summary(portfolio(spark, sf_dir).loans)


@query(
    "split_summary",
    f"ts AS ({TRAINING_SQL.strip()})\nSELECT split, count(*) AS loans, CAST(sum(CAST(is_loss AS INTEGER)) AS BIGINT) AS losses, "
    f"{rate('is_loss')} AS loss_rate FROM ts GROUP BY split",
)
def q_split_summary(spark, sf_dir):
    """Rows, losses and base rate by split."""
    p = portfolio(spark, sf_dir)
    return pf.split_summary(fx.training_set(p.joined, p.cfg))


_MERGED_SQL = """
SELECT f.loan_id, f.feat_003, f.feat_010_std, l.is_loss, CAST(l.loss_amount AS DOUBLE) AS loss_amount
FROM stg_loan_features f {how} JOIN stg_loans l USING (loan_id)
"""


def _merged(spark, sf_dir, how):
    p = portfolio(spark, sf_dir)
    features = p.features.select("loan_id", "feat_003", "feat_010_std")
    return pf.validated_merge(features, p.loans.select("loan_id", "is_loss", "loss_amount"), "loan_id", how)


@query("validated_merge", _MERGED_SQL.format(how="LEFT"))
def q_validated_merge(spark, sf_dir):
    """1:1-validated left merge of features with the outcomes."""
    return _merged(spark, sf_dir, "left")


@query("validated_merge_inner", _MERGED_SQL.format(how="INNER"))
def q_validated_merge_inner(spark, sf_dir):
    """The inner variant."""
    return _merged(spark, sf_dir, "inner")
