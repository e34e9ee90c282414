"""Domain configuration: every list and threshold the operators take.

All operators accept these as parameters; the module-level defaults below are
the values the original portfolio marts use, so results line up with them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must equal the original definitions for identical results).
# --------------------------------------------------------------------------

# Categorical predictors that are segmented and one-hot encoded.
CATEGORICAL_FEATURES = ["feat_001", "feat_003", "feat_004", "feat_015", "feat_041"]

# Portfolio KPI list: (group, name, unit, headline). Display order = position + 1.
KPI_DEFINITIONS = [
    ("volume", "funded_loan_count", "count", True),
    ("volume", "first_origination_date", "date", False),
    ("volume", "last_origination_date", "date", False),
    ("volume", "origination_window_days", "count", False),
    ("volume", "distinct_origination_days", "count", False),
    ("frequency", "loss_loan_count", "count", False),
    ("frequency", "non_loss_loan_count", "count", False),
    ("frequency", "portfolio_loss_rate", "rate", True),
    ("frequency", "funded_loan_count_last_12_months", "count", False),
    ("frequency", "loss_rate_last_12_months", "rate", True),
    ("frequency", "funded_loan_count_prior_12_months", "count", False),
    ("frequency", "loss_rate_prior_12_months", "rate", False),
    ("frequency", "loss_rate_12_month_change", "rate_change", True),
    ("severity", "total_recorded_loss_amount", "amount", True),
    ("severity", "total_positive_loss_amount", "amount", False),
    ("severity", "total_net_recovery_amount", "amount", False),
    ("severity", "average_loss_per_funded_loan", "amount", True),
    ("severity", "average_loss_severity", "amount", True),
    ("severity", "median_loss_severity", "amount", False),
    ("severity", "maximum_loss_amount", "amount", False),
    ("data_quality", "label_conflict_loan_count", "count", False),
    ("data_quality", "label_conflict_rate", "rate", False),
    ("data_quality", "net_recovery_loan_count", "count", False),
    ("data_quality", "missing_loss_amount_count", "count", False),
    ("data_quality", "missing_received_date_count", "count", False),
    ("data_quality", "duplicate_feature_vector_groups", "count", False),
    ("data_quality", "duplicate_feature_vector_loan_count", "count", False),
    ("data_quality", "duplicate_feature_vector_rate", "rate", True),
    ("data_quality", "distinct_feature_vector_count", "count", False),
]

# Loss-severity bands: (exclusive upper bound or None for open end, label).
SEVERITY_BANDS = [
    (10000, "$0-10k"),
    (25000, "$10k-25k"),
    (50000, "$25k-50k"),
    (100000, "$50k-100k"),
    (None, "$100k+"),
]

# Top-share thresholds of the concentration summary.
TOP_SHARE_THRESHOLDS = ["0.01", "0.05", "0.10", "0.20"]

# Segment rule: sample gate, then +/- percentage-point bands.
SEGMENT_MIN_LOANS = 100
SEGMENT_BAND_PP = 5
SEGMENT_LABELS = ("Insufficient sample", "High risk", "Low risk", "Portfolio-like")

# Rare-level rules: SQL training mart (< 100 train rows -> OTHER) and the
# fitted grouper of the severity pipeline (< 20 train rows -> RARE).
TRAIN_RARE_MIN_COUNT = 100
TRAIN_RARE_LABEL = "OTHER"
GROUPER_MIN_COUNT = 20
GROUPER_LABEL = "RARE"
MISSING_CATEGORY = "MISSING"
NULL_SEGMENT = "__NULL__"

# Trailing windows (months) anchored on the newest date.
TRAILING_MONTHS = 12

# Model defaults.
PROBABILITY_C = 1.0
SEVERITY_ALPHA = 100.0
RANDOM_SEED = 42


@dataclass(frozen=True)
class Sentinel:
    column: str
    threshold: float


@dataclass
class PortfolioConfig:
    """Everything an operator may need; override per table."""

    id_col: str = "loan_id"
    date_col: str = "received_date"
    label_col: str = "is_loss"
    amount_col: str = "loss_amount"
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL_FEATURES))
    boolean_features: list[str] = field(default_factory=lambda: ["feat_004", "feat_015"])
    string_features: list[str] = field(default_factory=lambda: ["feat_001", "feat_003", "feat_041"])
    sentinels: list[Sentinel] = field(default_factory=list)
    train_cutoff: str = "2024-10-01"
    rare_feature: str = "feat_001"

    @property
    def outcome_cols(self) -> list[str]:
        return [self.id_col, self.date_col, self.label_col, self.amount_col]
