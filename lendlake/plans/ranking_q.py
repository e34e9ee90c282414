"""Concentration curve (both window forms) and its top-share summary."""

from __future__ import annotations

from lendlake.config import TOP_SHARE_THRESHOLDS
from lendlake.operators import ranking
from lendlake.plans.registry import portfolio, query

# The loans stand in one ordered list; a loan's rank is its place there, and the
# total up to it is a sum over the list's prefix sums.
_ORDERED_SQL = """
ordered AS (
    SELECT list({id: loan_id, d: received_date, x: loss_amount} ORDER BY loss_amount DESC, loan_id) AS loans
    FROM loans_joined WHERE loss_amount > 0
)"""

_CURVE_SQL = _ORDERED_SQL + """,
placed AS (
    SELECT unnest(loans) AS loan, generate_subscripts(loans, 1) AS place, len(loans) AS population,
        list_sum(list_transform(loans, lambda v: v.x)) AS amount
    FROM ordered
)
SELECT loan.id AS loan_id, loan.d AS received_date, year(loan.d)::INT AS origination_year, loan.x::DOUBLE AS loss_amount,
    place AS loss_rank, population AS positive_loss_loan_count, place AS cumulative_positive_loss_loan_count,
    place / population AS cumulative_positive_loss_loan_share, amount::DOUBLE AS portfolio_positive_loss_amount,
    (sum(loan.x) OVER (ORDER BY place))::DOUBLE AS cumulative_positive_loss_amount,
    (sum(loan.x) OVER (ORDER BY place))::DOUBLE / amount::DOUBLE AS cumulative_positive_loss_share
FROM placed"""

_SUMMARY_SQL = _ORDERED_SQL + f""",
asked AS (SELECT unnest([{", ".join(f"{t}::DECIMAL(3,2)" for t in TOP_SHARE_THRESHOLDS)}]) AS share, loans FROM ordered),
sliced AS (SELECT share, len(loans) AS population, loans, loans[1:ceil(len(loans) * share)::BIGINT] AS head FROM asked)
SELECT share::DOUBLE AS top_share_threshold, len(head) AS positive_loss_loan_count,
    population AS positive_loss_loan_population, len(head) / population AS actual_loan_share,
    list_sum(list_transform(head, lambda v: v.x))::DOUBLE AS loss_amount,
    list_sum(list_transform(head, lambda v: v.x))::DOUBLE / list_sum(list_transform(loans, lambda v: v.x))::DOUBLE AS loss_share
FROM sliced
"""


@query("loss_concentration", _CURVE_SQL)
def q_loss_concentration(spark, sf_dir):
    """Concentration curve (bucketed global rank, default bucket count).

    The plain single-partition window form is kept for the tests only.
    """
    p = portfolio(spark, sf_dir)
    return ranking.loss_concentration(p.loans, p.cfg, method="scaled")


@query("loss_concentration_summary", _SUMMARY_SQL)
def q_loss_concentration_summary(spark, sf_dir):
    """Loss share of the top 1/5/10/20 % of loans."""
    p = portfolio(spark, sf_dir)
    conc = ranking.loss_concentration(p.loans, p.cfg, method="scaled")
    return ranking.concentration_summary(conc)
