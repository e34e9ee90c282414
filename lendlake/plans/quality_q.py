"""Data-quality suites over every staged table and mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lendlake.operators import features as fx
from lendlake.operators import marts, ranking
from lendlake.operators import quality as dq
from lendlake.operators.quality import Check
from lendlake.plans.registry import MEMOS, mart_cte, portfolio, query, staging_folder
from lendlake.sources.fixture import FEATURE_COLUMNS
from lendlake.sources.sinks import write_table

# Twin relation of every table name used by the checks.
MART_CTES = {
    "kpis": "portfolio_kpis_long",
    "kpis_wide": "portfolio_kpis_wide",
    "concentration": "loss_concentration",
    "summary": "loss_concentration_summary",
    "bands": "severity_bands",
    "segmentation": "risk_segmentation",
    "training_set": "ml_training_set",
    "severity_set": "ml_severity_set",
    "yearly": "portfolio_yearly",
    "quarterly": "portfolio_quarterly",
}
FIXTURE_RELS = ["raw_loans", "raw_features", "stg_loans", "stg_loan_features", "loans_joined"]


_MARTS: dict[tuple[str, str, str], DataFrame] = {}
MEMOS.append(_MARTS)


class Tables(dict):
    """Spark tables by name; a mart is written once per input folder and session.

    Checks and exports read the stored copy, so no check computes a mart again.
    """

    def __init__(self, spark, sf_dir):
        super().__init__()
        self.p = portfolio(spark, sf_dir)

    def __missing__(self, name):
        p = self.p
        build = {
            "raw_loans": lambda: p.raw_loans,
            "raw_features": lambda: p.raw_features,
            "stg_loans": lambda: p.loans,
            "stg_loan_features": lambda: p.features,
            "loans_joined": lambda: p.joined,
            "kpis": lambda: marts.portfolio_kpis(p.joined, p.cfg, p.loans),
            "kpis_wide": lambda: marts.kpi_wide(self["kpis"]),
            "concentration": lambda: ranking.loss_concentration(p.loans, p.cfg),
            "summary": lambda: ranking.concentration_summary(self["concentration"]),
            "bands": lambda: marts.severity_bands(p.loans, p.cfg),
            "segmentation": lambda: marts.risk_segmentation(p.joined, p.cfg),
            "training_set": lambda: fx.training_set(p.joined, p.cfg),
            "severity_set": lambda: fx.severity_set(p.joined, p.cfg),
            "yearly": lambda: marts.portfolio_yearly(p.loans, p.cfg),
            "quarterly": lambda: marts.portfolio_quarterly(p.loans, p.cfg),
        }[name]
        key = (p.spark.sparkContext.applicationId, p.sf_dir, name)
        if name in FIXTURE_RELS:
            self[name] = build()
        else:
            if key not in _MARTS:
                _MARTS[key] = write_table(build(), f"{staging_folder(p.spark, p.sf_dir)}/marts/{name}")
            self[name] = _MARTS[key]
        return self[name]


def _suite(name: str, checks: list[Check], doc: str):
    used = {c.table for c in checks} | {c.other for c in checks if c.other}
    ctes = [mart_cte(f"m_{t}", MART_CTES[t]) for t in MART_CTES if t in used]
    sources = {t: t for t in FIXTURE_RELS}
    sources.update({t: f"m_{t}" for t in MART_CTES})
    body = (",\n".join(ctes) + ",\n" if ctes else "") + dq.checks_sql(checks, sources)

    @query(name, body)
    def run(spark, sf_dir):
        return dq.run_checks(Tables(spark, sf_dir), checks)

    run.__doc__ = doc
    return run


def nn(table: str, *cols: str) -> list[Check]:
    return [Check("not_null", table, c) for c in cols]


def uq(table: str, *cols: str) -> list[Check]:
    return [Check("unique", table, c) for c in cols]


BOOL = [True, False]

SOURCE_CHECKS = [
    *uq("raw_loans", "loan_id"),
    *nn("raw_loans", "loan_id", "received_date", "is_loss"),
    Check("accepted_values", "raw_loans", "is_loss", values=BOOL),
    *uq("raw_features", "loan_id"),
    *nn("raw_features", "loan_id"),
    Check("relationships", "raw_features", "loan_id", other="raw_loans", other_column="loan_id"),
    Check("accepted_values", "raw_features", "feat_004", values=BOOL, where="feat_004 is not null"),
    Check("accepted_values", "raw_features", "feat_015", values=BOOL, where="feat_015 is not null"),
]

STAGING_CHECKS = [
    Check("equal_rowcount", "stg_loans", other="raw_loans"),
    Check("relationships", "stg_loans", "loan_id", other="stg_loan_features", other_column="loan_id"),
    *uq("stg_loans", "loan_id"),
    *nn("stg_loans", "loan_id", "received_date", "is_loss"),
    Check("equal_rowcount", "stg_loan_features", other="raw_features"),
    *uq("stg_loan_features", "loan_id"),
    *nn("stg_loan_features", "loan_id"),
    Check("equal_rowcount", "loans_joined", other="stg_loans"),
    *uq("loans_joined", "loan_id"),
    *nn("loans_joined", "loan_id", "received_date", "is_loss"),
    Check("accepted_values", "loans_joined", "is_loss", values=BOOL),
]

KPI_CHECKS = [
    *uq("kpis", "kpi_name", "kpi_display_order"),
    *nn("kpis", "kpi_name", "kpi_group", "kpi_unit", "kpi_display_order", "is_headline"),
    Check("accepted_values", "kpis", "kpi_group", values=["volume", "frequency", "severity", "data_quality"]),
    Check("accepted_values", "kpis", "kpi_unit", values=["count", "date", "rate", "rate_change", "amount"]),
    Check("expression", "kpis", expression="kpi_value >= 0 and kpi_value <= 1", where="kpi_unit = 'rate'"),
    Check("expression", "kpis", expression="kpi_value >= -1 and kpi_value <= 1", where="kpi_unit = 'rate_change'"),
    Check("expression", "kpis", expression="(kpi_value is null) <> (kpi_value_text is null)"),
    Check("expression", "kpis", expression="kpi_value >= 0", where="kpi_unit = 'count'"),
    *nn(
        "kpis_wide",
        "funded_loan_count",
        "portfolio_loss_rate",
        "loss_rate_last_12_months",
        "loss_rate_prior_12_months",
        "loss_rate_12_month_change",
        "total_recorded_loss_amount",
        "average_loss_per_funded_loan",
        "average_loss_severity",
        "duplicate_feature_vector_rate",
    ),
]

CONCENTRATION_CHECKS = [
    *uq("concentration", "loan_id", "loss_rank"),
    *nn(
        "concentration",
        "loan_id",
        "received_date",
        "origination_year",
        "loss_amount",
        "loss_rank",
        "positive_loss_loan_count",
        "cumulative_positive_loss_loan_count",
        "cumulative_positive_loss_loan_share",
        "portfolio_positive_loss_amount",
        "cumulative_positive_loss_amount",
        "cumulative_positive_loss_share",
    ),
    *uq("summary", "top_share_threshold"),
    *nn("summary", "top_share_threshold", "positive_loss_loan_count", "positive_loss_loan_population",
        "actual_loan_share", "loss_amount", "loss_share"),
    Check("accepted_values", "summary", "top_share_threshold", values=[0.01, 0.05, 0.10, 0.20]),
    *uq("bands", "severity_band", "severity_band_order"),
    *nn("bands", "severity_band", "severity_band_order", "loan_count", "positive_loss_loan_share",
        "total_positive_loss_amount", "positive_loss_amount_share"),
    Check("accepted_values", "bands", "severity_band", values=["$0-10k", "$10k-25k", "$25k-50k", "$50k-100k", "$100k+"]),
    Check("accepted_values", "bands", "severity_band_order", values=[1, 2, 3, 4, 5]),
]

SEGMENTATION_CHECKS = [
    Check("unique_combination", "segmentation", columns=["feature_name", "segment"]),
    *nn("segmentation", "feature_name", "segment", "funded_loan_count", "loss_loan_count",
        "positive_loss_loan_count", "observed_loss_rate", "portfolio_loan_share", "portfolio_loss_rate",
        "loss_rate_difference_pp", "is_material_segment", "risk_band"),
    Check("accepted_values", "segmentation", "feature_name", values=["feat_001", "feat_003", "feat_004", "feat_015", "feat_041"]),
    Check("accepted_values", "segmentation", "risk_band",
          values=["Insufficient sample", "High risk", "Low risk", "Portfolio-like"]),
]

ML_CHECKS = [
    *uq("training_set", "loan_id"),
    *nn("training_set", "loan_id", "split", "is_loss", "received_date", "feat_001_grouped"),
    Check("accepted_values", "training_set", "split", values=["train", "test"]),
    *uq("severity_set", "loan_id"),
    *nn("severity_set", "loan_id", "split", "loss_amount", "received_date", "is_loss", "feat_001"),
    Check("accepted_values", "severity_set", "split", values=["train", "test"]),
    Check("expression", "severity_set", expression="loss_amount > 0"),
]

TIME_CHECKS = [
    *uq("yearly", "origination_year"),
    *nn("yearly", "origination_year", "funded_loan_count", "loss_loan_count", "observed_loss_rate",
        "total_recorded_loss_amount", "total_positive_loss_amount", "average_loss_per_funded_loan"),
    *uq("quarterly", "origination_year_quarter_key"),
    Check("unique_combination", "quarterly", columns=["origination_year", "origination_quarter_number"]),
    *nn("quarterly", "origination_year_quarter_key", "origination_year", "origination_quarter_number",
        "origination_quarter_name", "origination_quarter_start", "funded_loan_count"),
    Check("accepted_values", "quarterly", "origination_quarter_name", values=["Q1", "Q2", "Q3", "Q4"]),
    Check("accepted_values", "quarterly", "origination_quarter_number", values=[1, 2, 3, 4]),
]

_suite("dq_sources", SOURCE_CHECKS, "C1-C4 on the raw tables (S1 sources).")
_suite("dq_staging", STAGING_CHECKS, "C1, C2, C3, C4, C5 on staging and the joined view.")
_suite("dq_kpis", KPI_CHECKS, "C1-C3, C6 on the KPI marts.")
_suite("dq_concentration", CONCENTRATION_CHECKS, "C1-C3 on curve, summary and bands.")
_suite("dq_segmentation", SEGMENTATION_CHECKS, "C2, C3, C7 on the segmentation mart.")
_suite("dq_ml_sets", ML_CHECKS, "C1-C3, C6 on the model marts.")
_suite("dq_time_trend", TIME_CHECKS, "C1-C3, C7 on the cohort marts.")


# ---------------------------------------------------------------- table-level assertions

def _m(*names: str) -> str:
    return ",\n".join(mart_cte(f"m_{n}", MART_CTES[n]) for n in names) + ",\n"


@query(
    "dq_curve",
    _m("concentration")
    + """
a AS (SELECT CAST(count(*) AS BIGINT) AS row_count, max(cumulative_positive_loss_loan_share) AS final_loan_share,
    max(cumulative_positive_loss_share) AS final_loss_share FROM m_concentration)
SELECT *, row_count > 0 AND coalesce(abs(final_loan_share - 1) <= 0.000001, false)
    AND coalesce(abs(final_loss_share - 1) <= 0.000001, false) AS passed FROM a
""",
)
def q_dq_curve(spark, sf_dir):
    """The concentration curve ends at (1, 1)."""
    return dq.curve_reaches_one(Tables(spark, sf_dir)["concentration"])


@query(
    "dq_wide_single_row",
    _m("kpis", "kpis_wide") + "a AS (SELECT CAST(count(*) AS BIGINT) AS row_count FROM m_kpis_wide)\nSELECT *, row_count = 1 AS passed FROM a",
)
def q_dq_wide_single_row(spark, sf_dir):
    """The wide KPI mart has exactly one row."""
    return dq.single_row(Tables(spark, sf_dir)["kpis_wide"])


@query(
    "dq_split",
    _m("training_set")
    + """
a AS (SELECT max(CASE WHEN split = 'train' THEN received_date END) AS last_train_date,
    min(CASE WHEN split = 'test' THEN received_date END) AS first_test_date,
    CAST(count(*) AS BIGINT) AS row_count FROM m_training_set)
SELECT *, coalesce(last_train_date < first_test_date, false) AS passed FROM a
""",
)
def q_dq_split(spark, sf_dir):
    """The split is chronological."""
    return dq.split_is_chronological(Tables(spark, sf_dir)["training_set"])


@query(
    "dq_shares",
    _m("segmentation")
    + """
a AS (SELECT feature_name, sum(portfolio_loan_share) AS total_loan_share,
    sum(portfolio_positive_loss_share) AS total_positive_loss_share FROM m_segmentation GROUP BY feature_name)
SELECT *, coalesce(abs(total_loan_share - 1) <= 0.000001 AND abs(total_positive_loss_share - 1) <= 0.000001, false) AS passed FROM a
UNION ALL SELECT NULL, NULL, NULL, false WHERE NOT EXISTS (SELECT 1 FROM a)
""",
)
def q_dq_shares(spark, sf_dir):
    """C11: segmentation shares sum to 1 per feature."""
    return dq.shares_sum_to_one(Tables(spark, sf_dir)["segmentation"])


@query(
    "dq_bands",
    _m("bands")
    + """
a AS (SELECT CAST(count(*) AS BIGINT) AS row_count, sum(positive_loss_loan_share) AS total_loan_share,
    sum(positive_loss_amount_share) AS total_amount_share FROM m_bands)
SELECT *, row_count > 0 AND coalesce(abs(total_loan_share - 1) <= 0.000001
    AND abs(total_amount_share - 1) <= 0.000001, false) AS passed FROM a
""",
)
def q_dq_bands(spark, sf_dir):
    """Band shares sum to 1."""
    return dq.band_shares_sum_to_one(Tables(spark, sf_dir)["bands"])


@query(
    "dq_reconcile",
    _m("yearly")
    + """
mt AS (SELECT CAST(sum(funded_loan_count) AS BIGINT) AS mart_loans, CAST(sum(loss_loan_count) AS BIGINT) AS mart_losses FROM m_yearly),
st AS (SELECT CAST(count(*) AS BIGINT) AS source_loans, CAST(sum(CAST(is_loss AS INTEGER)) AS BIGINT) AS source_losses
    FROM loans_joined WHERE received_date IS NOT NULL)
SELECT mart_loans, source_loans, mart_losses, source_losses,
    mart_loans IS NOT DISTINCT FROM source_loans AND mart_losses IS NOT DISTINCT FROM source_losses AND source_loans > 0 AS passed
FROM mt CROSS JOIN st
""",
)
def q_dq_reconcile(spark, sf_dir):
    """The yearly mart reconciles to the dated source rows."""
    t = Tables(spark, sf_dir)
    return dq.yearly_reconciles(t["yearly"], t["loans_joined"])


@query(
    "dq_straddle",
    _m("training_set")
    + f"""
rows_of AS (
    SELECT count(*) OVER v AS n, min(split) OVER v <> max(split) OVER v AS both_sides, row_number() OVER v AS nth
    FROM loans_joined JOIN (SELECT loan_id, split FROM m_training_set) USING (loan_id)
    WINDOW v AS (PARTITION BY {", ".join(FEATURE_COLUMNS)}))
SELECT count(*) FILTER (nth = 1) AS groups, count(*) FILTER (nth = 1 AND n > 1) AS duplicate_groups,
    count(*) FILTER (nth = 1 AND both_sides) AS straddling_groups,
    count(*) > 0 AND count(*) FILTER (nth = 1 AND both_sides) = 0 AS passed FROM rows_of
""",
)
def q_dq_straddle(spark, sf_dir):
    """C14: no duplicate feature vector (all predictors) straddles the chronological split."""
    t = Tables(spark, sf_dir)
    labelled = fx.label_split(t["loans_joined"], t.p.cfg)
    return dq.no_group_straddles_split(labelled, FEATURE_COLUMNS)
