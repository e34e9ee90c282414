"""Column-expression helpers (all JVM-side built-ins, no Python UDFs).

Scalar functions of the inventory and where they live: F1 casts (staging),
F2/F3 year, quarter, trunc (cohorts), F4 datediff, F5 add_months, F6
date_format (KPI record), F7 date parameters (``split_label``), F8 concat
(quarter keys), F9 coalesce / nullif (``ratio``), F10 ceil (top-share
cutoffs), F11 abs (errors), F12 log1p / expm1 (severity target), F13
``clip``, F14 round (scoring record), F15 percentage points (segmentation),
F16 case/when (``when_chain``), F17 isNull (checks), F18 isin / semi joins
(accepted values, scoring ids), F19 string aggregation re-aimed (profiling),
F20 ``profiling.column_family``, F21 sqrt / ln (RMSE, BIC).

Every helper returns a ``Column`` so it can sit inside one ``select``/``agg``
and stay in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / nullif(den, 0) in double (never decimal division)."""
    d = col(den).cast("double")
    return col(num).cast("double") / F.when(d != 0, d)


def mean_of(x: str | Column) -> Column:
    """Mean as double(sum) / count — exact for decimals and order-free.

    ``avg(decimal)`` in Spark returns a decimal with 4 extra digits; casting
    the exact decimal sum to double and dividing reproduces a double mean
    that does not depend on the order of the inputs.
    """
    return F.sum(col(x)).cast("double") / F.count(col(x))


def rate_of(flag: str | Column) -> Column:
    """Mean of a boolean as a rate (NULL flags ignored)."""
    return mean_of(col(flag).cast("int"))


def decimal_median(x: str | Column, scale: int = 2, precision: int = 12) -> Column:
    """Exact median of a decimal column, kept in the decimal type.

    The midpoint of two cents values is truncated toward zero to the column
    scale (1.00/1.01 -> 1.00, -1.01/-1.02 -> -1.01), the convention of the
    marts this reproduces.
    """
    m = F.median(col(x))
    factor = 10**scale
    return (
        (m.cast(f"decimal({precision + 4},{scale + 2})") * F.lit(factor)).cast("bigint")
        / F.lit(factor)
    ).cast(f"decimal({precision},{scale})")


def is_conflict(label: str | Column, amount: str | Column) -> Column:
    """Label disagrees with the amount's sign (amount present)."""
    return col(amount).isNotNull() & (col(label) != (col(amount) > 0))


def when_chain(conditions: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    expr = None
    for cond, value in conditions:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)


def band_order(amount: str | Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """1-based band number for half-open bands with exclusive upper bounds."""
    conds = [(col(amount) < F.lit(upper), i + 1) for i, (upper, _) in enumerate(bands) if upper is not None]
    return when_chain(conds, len(bands))


def band_label(amount: str | Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    conds = [(col(amount) < F.lit(upper), label) for upper, label in bands if upper is not None]
    return when_chain(conds, bands[-1][1])


def split_label(date: str | Column, cutoff: str) -> Column:
    """'train' strictly before the cutoff, else 'test' (NULL date -> test)."""
    return F.when(col(date) < F.lit(cutoff).cast("date"), "train").otherwise("test")


def sentinel_to_null(x: str | Column, threshold: float) -> Column:
    return F.when(col(x) >= F.lit(threshold), F.lit(None)).otherwise(col(x))


def sentinel_flag(x: str | Column, threshold: float) -> Column:
    """1 only when a code was present; a native NULL gives 0."""
    return F.when(col(x) >= F.lit(threshold), 1).otherwise(0)


def null_to_segment(x: str | Column, null_label: str = "__NULL__") -> Column:
    return F.coalesce(col(x).cast("string"), F.lit(null_label))


def sign_group(amount: str | Column) -> Column:
    a = col(amount)
    return (
        F.when(a.isNull(), "missing")
        .when(a > 0, "positive")
        .when(a == 0, "zero")
        .otherwise("negative")
    )


def any_null(cols: Sequence[str]) -> Column:
    """True when any of the columns is NULL (row-wise)."""
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def all_null(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNull()
    return out
