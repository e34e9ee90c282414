"""Column profiling and outcome diagnostics.

Wide profiles are one aggregate pass whose single result row is unpivoted
(``explode(array(struct))``) — the data itself is never multiplied by the
number of columns.  Only per-value frequency tables group the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.functions import any_null, all_null, mean_of, rate_of, sign_group
from lendlake.operators.quantiles import exact_quantiles


def _explode_rows(one: DataFrame, rows: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _with_median(agg: DataFrame, src: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Join an exact median (selection, bounded memory) onto a grouped result."""
    med = exact_quantiles(src, keys, value, [0.5], "__q").select(*keys, F.col("__q")[0].alias(out))
    return agg.join(med, [agg[k].eqNullSafe(med[k]) for k in keys], "left").select(
        *[agg[c] for c in agg.columns], med[out]
    )


def _total(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


# ---------------------------------------------------------------- splits, categories, levels


def split_summary(df: DataFrame, label: str = "is_loss", split: str = "split") -> DataFrame:
    """Rows, losses and base rate by split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum(F.col(label).cast("int")).cast("bigint").alias("losses"),
        rate_of(label).alias("loss_rate"),
    )


def category_summary(df: DataFrame, column: str, include_missing: bool = True, missing_label: str = "Missing") -> DataFrame:
    """Count and percentage of every level (NULL kept as its own level when asked)."""
    src = df if include_missing else df.where(F.col(column).isNotNull())
    level = F.coalesce(F.col(column).cast("string"), F.lit(missing_label)) if include_missing else F.col(column).cast("string")
    g = src.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("level", "count", (F.col("count") * 100.0 / _total(src)).alias("percent"))


def loss_by_level(
    df: DataFrame, feature: str, label: str = "is_loss", amount: str = "loss_amount", include_missing: bool = True
) -> DataFrame:
    """Count, losses, loss rate (and %), mean amount per level."""
    src = df if include_missing else df.where(F.col(feature).isNotNull())
    level = F.coalesce(F.col(feature).cast("string"), F.lit("Missing"))
    return src.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum(F.col(label).cast("int")).cast("bigint").alias("losses"),
        rate_of(label).alias("loss_rate"),
        (rate_of(label) * 100).alias("loss_rate_pct"),
        mean_of(amount).alias("mean_loss_amount"),
    )


def median_by_level(df: DataFrame, feature: str, amount: str, top_n: int = 10) -> DataFrame:
    """A25 + O4: median amount of the ``top_n`` most frequent levels (a top-k report)."""
    g = df.groupBy(feature).agg(F.count(F.lit(1)).alias("loans"))
    top = g.where(F.col(feature).isNotNull()).orderBy(F.col("loans").desc(), feature).limit(top_n)
    return _with_median(top, df.join(top.select(feature), feature, "left_semi"), [feature], amount, "median_amount")


def amount_profile_by_label(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount") -> DataFrame:
    """Count, missing, min, median, mean, max of the amount by label."""
    a = F.col(amount).cast("double")
    g = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(amount).isNull()).alias("missing"),
        F.min(a).alias("min"),
        mean_of(F.col(amount)).alias("mean"),
        F.max(a).alias("max"),
    )
    return _with_median(g, df, [label], amount, "median").select(label, "rows", "missing", "min", "median", "mean", "max")


def sign_label_crosstab(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount") -> DataFrame:
    """A27 + P12: sign group x label counts, the larger column and the difference."""
    g = df.groupBy(sign_group(amount).alias("amount_sign")).agg(
        F.count_if(~F.col(label)).alias("label_false"),
        F.count_if(F.col(label)).alias("label_true"),
    )
    return g.select(
        "amount_sign",
        "label_false",
        "label_true",
        F.when(F.col("label_true") > F.col("label_false"), "label_true")
        .when(F.col("label_true") < F.col("label_false"), "label_false")
        .otherwise("tie")
        .alias("higher_count"),
        (F.col("label_true") - F.col("label_false")).alias("difference"),
    )


def repeated_patterns(df: DataFrame, keys: Sequence[str], id_col: str = "loan_id") -> DataFrame:
    """Value combinations held by more than one row, the most frequent first.

    The reference renders the member ids as one joined string per group; a
    hot combination would then funnel an unbounded list into one task.  Here
    each group reports its size and id range (bounded aggregates); the members
    themselves are ``repeated_members``.
    """
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")
    )
    return g.where(F.col("rows") > 1).orderBy(F.col("rows").desc(), *keys)


def flagged_not_positive(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount") -> DataFrame:
    """The rows A28 looks at: flagged as a loss with an amount of zero or less."""
    return df.where(F.col(label) & (F.col(amount) <= 0))


def repeated_members(df: DataFrame, keys: Sequence[str], id_col: str = "loan_id") -> DataFrame:
    """Members of the repeated groups, one row each (window count per key)."""
    named = [F.col(k).alias(f"__{k}") for k in keys]
    g = df.groupBy(*named).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.select(*keys, id_col).join(g, on, "inner").select(*keys, id_col, "rows")


def outcome_shares(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount") -> DataFrame:
    """Share of rows per label and per amount sign."""
    n = F.count(F.lit(1))
    return df.agg(
        (F.count_if(F.col(label)) / n).alias("share_label_true"),
        (F.count_if(~F.col(label)) / n).alias("share_label_false"),
        (F.count_if(F.col(amount) > 0) / n).alias("share_positive"),
        (F.count_if(F.col(amount) == 0) / n).alias("share_zero"),
        (F.count_if(F.col(amount) < 0) / n).alias("share_negative"),
        (F.count_if(F.col(amount).isNull()) / n).alias("share_missing"),
    )


# ---------------------------------------------------------------- nulls


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    """NULL count and % per column (one aggregate pass), most NULLs first, then by name."""
    cols = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("bigint").alias("null_count"),
            (F.col(c) * 100.0 / F.col("__n")).alias("null_pct"),
        )
        for c in cols
    ]
    out = _explode_rows(one, rows)
    out = out.where(F.col("null_count") > 0) if only_positive else out
    return out.orderBy(F.col("null_count").desc(), "column_name")


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, columns per data type and missing cells in total."""
    cols = list(columns or df.columns)
    mix = dtype_mix(df.select(*cols))
    nulls = sum(F.col(c).isNull().cast("bigint") for c in cols)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("missing_cells")).select(
        "rows", F.lit(len(cols)).alias("columns"), "missing_cells",
        *[F.lit(n).alias(f"columns_{kind}") for kind, n in sorted(mix.items())],
    )


def dtype_mix(df: DataFrame) -> dict[str, int]:
    """A31 (plan-time helper): number of columns per data type."""
    mix: dict[str, int] = {}
    for f in df.schema.fields:
        mix[f.dataType.typeName()] = mix.get(f.dataType.typeName(), 0) + 1
    return mix


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A37 + P10: rows with any / all of the columns NULL."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null(columns)).alias("rows_any_null"),
        F.count_if(all_null(columns)).alias("rows_all_null"),
    )


def missing_flag_outcome(df: DataFrame, columns: Sequence[str], label: str, amount: str, date: str) -> DataFrame:
    """Outcome by an "any of the columns missing" flag."""
    flagged = df.withColumn("any_missing", any_null(columns))
    g = flagged.groupBy("any_missing").agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum(F.col(label).cast("int")).cast("bigint").alias("losses"),
        rate_of(label).alias("loss_rate"),
        (rate_of(label) * 100).alias("loss_rate_pct"),
        mean_of(amount).alias("mean_loss_amount"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )
    out = _with_median(g, flagged, ["any_missing"], amount, "median_loss_amount")
    return out.select(
        "any_missing", "loans", "losses", "loss_rate", "loss_rate_pct", "mean_loss_amount", "median_loss_amount",
        "first_date", "last_date",
    )


def rows_with_nulls(df: DataFrame, columns: Sequence[str], id_col: str = "loan_id") -> DataFrame:
    """P10: the rows in which any of the columns is NULL, with these columns."""
    return df.where(any_null(columns)).select(id_col, *columns)


def missing_vs_outcome(df: DataFrame, columns: Sequence[str], label: str = "is_loss") -> DataFrame:
    """Loss rate when a column is missing vs present, ranked by |difference|.

    One aggregate pass over all columns (four conditional sums each).
    """
    lab = F.col(label).cast("int")
    aggs = []
    for i, c in enumerate(columns):
        miss = F.col(c).isNull()
        aggs += [
            F.count_if(miss).alias(f"nm{i}"),
            F.sum(F.when(miss, lab)).alias(f"lm{i}"),
            F.count_if(~miss & F.col(label).isNotNull()).alias(f"np{i}"),
            F.sum(F.when(~miss, lab)).alias(f"lp{i}"),
        ]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(columns):
        rm = F.col(f"lm{i}").cast("double") / F.when(F.col(f"nm{i}") > 0, F.col(f"nm{i}"))
        rp = F.col(f"lp{i}").cast("double") / F.when(F.col(f"np{i}") > 0, F.col(f"np{i}"))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"nm{i}").cast("bigint").alias("missing_rows"),
                rm.alias("loss_rate_missing"),
                rp.alias("loss_rate_present"),
                (rm - rp).alias("difference"),
            )
        )
    found = _explode_rows(one, rows).where(F.col("missing_rows") > 0)
    return found.orderBy(F.abs("difference").desc_nulls_last(), "column_name")


def missing_by_year(df: DataFrame, columns: Sequence[str], date: str = "received_date") -> DataFrame:
    """% missing per year for chosen columns."""
    return df.groupBy(F.year(date).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"{c}_missing_pct") for c in columns],
    )


# ---------------------------------------------------------------- numeric profiles


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, nulls, min, max, median, mean, sample std per column.

    One wide aggregate (one median buffer per column), unpivoted afterwards.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.count_if(x.isNull()).alias(f"z{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
            F.avg(x).alias(f"mu{i}"),
            F.stddev_samp(x).alias(f"sd{i}"),
        ]
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("count"),
            F.col(f"z{i}").cast("bigint").alias("nulls"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            F.col(f"mu{i}").alias("mean"),
            F.col(f"sd{i}").alias("std"),
        )
        for i, c in enumerate(columns)
    ]
    prof = _explode_rows(one, rows)
    long = unpivot_values(df, columns)
    out = _with_median(prof, long, ["column_name"], "value", "median")
    return out.select("column_name", column_family("column_name").alias("column_family"),
                      "count", "nulls", "min", "max", "median", "mean", "std")


# Fixed value: the aggregate-suffix naming convention of the feature columns.
FAMILY_PATTERN = "_(min|max|mean|sum|trend|cv|std)$"


def column_family(name_col: str | Column) -> Column:
    """aggregate suffix of a feature column name ('' when there is none)."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.regexp_extract(c, FAMILY_PATTERN, 1)


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """F20 (plan-time helper): columns grouped by suffix family, to feed A32."""
    import re

    groups: dict[str, list[str]] = {}
    for c in columns:
        m = re.search(FAMILY_PATTERN, c)
        groups.setdefault(m.group(1) if m else "", []).append(c)
    return groups


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """A small row sample for viewing (a limit is the feature here)."""
    return df.limit(n)


def unpivot_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) rows for per-column quantiles (NULLs dropped)."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("value").isNotNull())


def describe(df: DataFrame, column: str, by: str | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, std, min, exact interpolated quantiles, max (optionally by a key)."""
    x = F.col(column).cast("double")
    aggs = [
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    ]
    keys = [by] if by else []
    if by:
        g = df.groupBy(by).agg(*aggs)
        q = exact_quantiles(df, keys, column, quantiles, "__q")
        g = g.join(q, [g[by].eqNullSafe(q[by])], "left").select(*[g[c] for c in g.columns], q["__q"])
    else:
        g = df.agg(*aggs).select("*", exact_quantiles(df, [], column, quantiles, "__q").scalar().alias("__q"))
    qcols = [F.col("__q")[i].alias(f"q{int(round(v * 100)):02d}") for i, v in enumerate(quantiles)]
    return g.select(*keys, "count", "mean", "std", "min", *qcols, "max")


def skewness_profile(df: DataFrame, column: str) -> DataFrame:
    """Bias-corrected sample skewness of x and of log1p(x) (x > -1 rows for the log)."""
    x = F.col(column).cast("double")

    def corrected(e: Column) -> Column:
        n = F.count(e)
        return F.skewness(e) * F.sqrt(n * (n - 1)) / (n - 2)

    return df.agg(
        corrected(x).alias("skew_raw"),
        corrected(F.when(x > -1, F.log1p(x))).alias("skew_log1p"),
    )


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every column with the target, one pass, by falling size.

    Pairwise complete; a constant column has no correlation and comes last.
    """
    t = F.col(target).cast("double")

    def correlation(c: str) -> Column:
        x = F.when(t.isNotNull(), F.col(c).cast("double"))
        y = F.when(F.col(c).isNotNull(), t)
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    one = df.agg(*[correlation(c).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("correlation")) for i, c in enumerate(columns)]
    out = _explode_rows(one, rows)
    out = out.select("*", F.abs("correlation").alias("abs_correlation"))
    return out.orderBy(F.col("abs_correlation").desc_nulls_last(), "column_name")


def value_frequency(df: DataFrame, columns: Sequence[str], values: Sequence[float]) -> DataFrame:
    """How often each candidate (sentinel) value occurs in each column, one pass."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    keys = []
    for i, c in enumerate(columns):
        for j, v in enumerate(values):
            aggs.append(F.count_if(F.col(c).cast("double") == F.lit(float(v))).alias(f"f{i}_{j}"))
            keys.append((i, c, j, v))
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(float(v)).alias("value"),
            F.col(f"f{i}_{j}").cast("bigint").alias("rows"),
            (F.col(f"f{i}_{j}") * 100.0 / F.col("__n")).alias("pct"),
        )
        for i, c, j, v in keys
    ]
    return _explode_rows(one, rows).where(F.col("rows") > 0)


def mass_at_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column's maximum and how many rows sit on it (two passes)."""
    maxes = df.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns])
    m = maxes.select(F.struct(*columns).alias("m")).scalar()
    one = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(c).cast("double") == m[c]).alias(f"k{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"x{i}").alias("max_value"),
            F.col(f"k{i}").cast("bigint").alias("rows_at_max"),
            (F.col(f"k{i}") * 100.0 / F.col("__n")).alias("pct_at_max"),
        )
        for i, c in enumerate(columns)
    ]
    return _explode_rows(one, rows)


def mean_and_mass_at(df: DataFrame, columns: Sequence[str], value: float) -> DataFrame:
    """Column mean and share of rows equal to a reference value (explicit parameter)."""
    one = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c).cast("double") == F.lit(float(value))).alias(f"k{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"k{i}").cast("bigint").alias("rows_at_value"),
            (F.col(f"k{i}") * 100.0 / F.col("__n")).alias("pct_at_value"),
        )
        for i, c in enumerate(columns)
    ]
    return _explode_rows(one, rows)


# ---------------------------------------------------------------- keys, conflicts, merges


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows vs distinct keys (unique when equal)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(key).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def date_range(df: DataFrame, date: str) -> DataFrame:
    """First / last date and number of distinct dates."""
    distinct = df.select(date).where(F.col(date).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date")).select(
        "*", distinct.alias("distinct_dates")
    )


def label_conflicts(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount", id_col: str = "loan_id") -> DataFrame:
    """Conflicting rows (flagged with amount <= 0, or unflagged with amount > 0)."""
    a, lab = F.col(amount), F.col(label)
    kind = F.when(lab & (a <= 0), "flagged_not_positive").when(~lab & (a > 0), "unflagged_positive")
    return df.select(id_col, label, amount, kind.alias("conflict_kind")).where(F.col("conflict_kind").isNotNull())


def conflict_summary(df: DataFrame, label: str = "is_loss", amount: str = "loss_amount") -> DataFrame:
    """Counts of both conflict kinds and their share of the rows."""
    a, lab = F.col(amount), F.col(label)
    n = F.count(F.lit(1))
    return df.agg(
        F.count_if(lab & (a <= 0)).alias("flagged_not_positive"),
        F.count_if(~lab & (a > 0)).alias("unflagged_positive"),
        (F.count_if(lab & (a <= 0)) / n).alias("flagged_not_positive_share"),
        (F.count_if(~lab & (a > 0)) / n).alias("unflagged_positive_share"),
    )


def validated_merge(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join after checking both keys are unique (one aggregate per side).

    Raises ``ValueError`` when either side repeats a key.
    """
    for name, side in (("left", left), ("right", right)):
        dup = side.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).count()
        if dup:
            raise ValueError(f"{name} side of the merge repeats values of {key!r}")
    return left.join(right, key, how)
