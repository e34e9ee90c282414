"""Data-quality checks as table operators.

A check is declared as a ``Check`` and run by ``run_checks``, which returns
one summary row per check: ``(check_name, table_name, column_name,
n_violations, passed)``.  All row-level predicates of one table (not_null,
accepted_values, expression_is_true) are answered by one aggregate pass, and
all its unique keys by one more (partial aggregation keeps hot keys cheap).  ``violations`` returns the offending rows for any check.

Unlike the declarative tests they reproduce, the table-level assertions
(C8-C13) fail on an empty table instead of passing silently: comparisons are
null-safe and a row is required.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.operators.duplicates import repeats


@dataclass
class Check:
    kind: str  # unique | not_null | accepted_values | expression | unique_combination | relationships | equal_rowcount
    table: str
    column: str | None = None
    values: Sequence = field(default_factory=list)
    where: str | None = None
    expression: str | None = None
    columns: Sequence[str] = field(default_factory=list)
    other: str | None = None  # parent / compared table
    other_column: str | None = None

    @property
    def name(self) -> str:
        target = self.column or ",".join(self.columns) or self.expression or self.other or ""
        return f"{self.kind}:{self.table}:{target}" + (f":{self.where}" if self.where else "")


def _violation_predicate(c: Check) -> Column:
    if c.kind == "not_null":
        cond = F.col(c.column).isNull()
    elif c.kind == "accepted_values":
        cond = ~F.col(c.column).isin(list(c.values))  # NULL -> not a violation
    elif c.kind == "expression":
        cond = ~F.expr(c.expression)  # NULL -> not a violation
    else:
        raise ValueError(c.kind)
    if c.where:
        cond = F.expr(c.where) & cond
    return F.coalesce(cond, F.lit(False))


ROW_LEVEL = {"not_null", "accepted_values", "expression"}


def violations(tables: dict[str, DataFrame], c: Check) -> DataFrame:
    """The offending rows (or keys) of one check."""
    df = tables[c.table]
    if c.kind in ROW_LEVEL:
        return df.where(_violation_predicate(c))
    if c.kind == "unique":
        return (
            df.where(F.col(c.column).isNotNull())
            .groupBy(c.column)
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1)
        )
    if c.kind == "unique_combination":
        return df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if c.kind == "relationships":
        child = df.where(F.col(c.column).isNotNull()).select(c.column)
        parent = tables[c.other].select(F.col(c.other_column or c.column).alias("__parent"))
        return child.join(parent, child[c.column] == parent["__parent"], "left_anti")
    if c.kind == "equal_rowcount":
        a = df.agg(F.count(F.lit(1)).alias("a"))
        b = tables[c.other].agg(F.count(F.lit(1)).alias("b")).select(F.col("b")).scalar()
        return a.select("a", b.alias("b")).where(~(F.col("a") == F.col("b")))
    raise ValueError(c.kind)


UNIQUE = {"unique", "unique_combination"}


def _key(c: Check) -> Column:
    """The key of a uniqueness check as one string, exact; NULL where the row has none."""
    if c.kind == "unique":
        return F.col(c.column).cast("string")
    text = [F.col(x).cast("string") for x in c.columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def _repeated_keys(df: DataFrame, group: Sequence[tuple[int, Check]]) -> DataFrame:
    """One row: how many keys of each check occur more than once.  All checks of a table share one read and one shuffle."""
    keys = F.array(*[F.struct(F.lit(i).alias("check"), _key(c).alias("key")) for i, c in group])
    counted = df.select(F.explode(keys).alias("k")).select("k.*").where(F.col("key").isNotNull()).groupBy("check", "key")
    again = counted.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return again.agg(*[F.count_if(F.col("check") == i).alias(f"v{i}") for i, _ in group])


def _summary(one: DataFrame, group: Sequence[tuple[int, Check]]) -> DataFrame:
    """The summary rows of the checks whose violations are the columns ``v<order>`` of one row."""
    rows = [
        F.struct(
            F.lit(i).alias("check_order"),
            F.lit(c.kind).alias("check_kind"),
            F.lit(c.name).alias("check_name"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).cast("string").alias("column_name"),
            F.col(f"v{i}").cast("bigint").alias("n_violations"),
        )
        for i, c in group
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Summary table of the checks (one row each, in declaration order)."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        if c.kind in ROW_LEVEL:
            by_table.setdefault(c.table, []).append((i, c))
    for tname, group in by_table.items():
        one = tables[tname].agg(*[F.count_if(_violation_predicate(c)).alias(f"v{i}") for i, c in group])
        parts.append(_summary(one, group))
    unique: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        if c.kind in UNIQUE:
            unique.setdefault(c.table, []).append((i, c))
    for tname, group in unique.items():
        parts.append(_summary(_repeated_keys(tables[tname], group), group))
    for i, c in enumerate(checks):
        if c.kind in ROW_LEVEL | UNIQUE:
            continue
        v = violations(tables, c)
        n = v.agg(F.count(F.lit(1)).cast("bigint").alias("n_violations"))
        parts.append(
            n.select(
                F.lit(i).alias("check_order"),
                F.lit(c.kind).alias("check_kind"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.table).alias("table_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                "n_violations",
            )
        )
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("n_violations") == 0)


def checks_sql(checks: Sequence[Check], sources: dict[str, str]) -> str:
    """The same check suite as SQL text (``sources``: table name -> SQL relation)."""
    parts = []
    for i, c in enumerate(checks):
        rel = sources[c.table]
        col = "NULL" if c.column is None else f"'{c.column}'"
        head = f"SELECT {i} AS check_order, '{c.kind}' AS check_kind, '{_q(c.name)}' AS check_name, '{c.table}' AS table_name, CAST({col} AS VARCHAR) AS column_name, "
        if c.kind in ROW_LEVEL:
            if c.kind == "not_null":
                cond = f"{c.column} IS NULL"
            elif c.kind == "accepted_values":
                cond = f"NOT ({c.column} IN ({', '.join(_lit(v) for v in c.values)}))"
            else:
                cond = f"NOT ({c.expression})"
            if c.where:
                cond = f"({c.where}) AND {cond}"
            parts.append(head + f"CAST(count(*) FILTER (WHERE coalesce({cond}, false)) AS BIGINT) AS n_violations FROM {rel}")
        elif c.kind == "unique":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS n_violations FROM (SELECT {c.column} FROM {rel} WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1)")
        elif c.kind == "unique_combination":
            cols = ", ".join(c.columns)
            parts.append(head + f"CAST(count(*) AS BIGINT) AS n_violations FROM (SELECT {cols} FROM {rel} GROUP BY {cols} HAVING count(*) > 1)")
        elif c.kind == "relationships":
            prel = sources[c.other]
            pc = c.other_column or c.column
            parts.append(head + f"CAST(count(*) AS BIGINT) AS n_violations FROM {rel} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {prel} pa WHERE pa.{pc} = ch.{c.column})")
        elif c.kind == "equal_rowcount":
            prel = sources[c.other]
            parts.append(head + f"CAST(CASE WHEN (SELECT count(*) FROM {rel}) = (SELECT count(*) FROM {prel}) THEN 0 ELSE 1 END AS BIGINT) AS n_violations")
    body = "\nUNION ALL\n".join(parts)
    return f"chk AS (\n{body}\n)\nSELECT *, n_violations = 0 AS passed FROM chk"


def _q(s: str) -> str:
    return s.replace("'", "''")


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + _q(str(v)) + "'"


# --------------------------------------------------------------------------
# Table-level assertions (C8-C14).  Each returns one row with the measured
# values and ``passed``; an empty input fails.
# --------------------------------------------------------------------------


def curve_reaches_one(conc: DataFrame, tol: float = 1e-6) -> DataFrame:
    """The last point of the concentration curve is (1, 1)."""
    one = conc.agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"),
        F.max("cumulative_positive_loss_loan_share").alias("final_loan_share"),
        F.max("cumulative_positive_loss_share").alias("final_loss_share"),
    )
    ok = (
        (F.col("row_count") > 0)
        & F.coalesce(F.abs(F.col("final_loan_share") - 1) <= tol, F.lit(False))
        & F.coalesce(F.abs(F.col("final_loss_share") - 1) <= tol, F.lit(False))
    )
    return one.withColumn("passed", ok)


def single_row(df: DataFrame) -> DataFrame:
    """Exactly one row."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).withColumn("passed", F.col("row_count") == 1)


def split_is_chronological(df: DataFrame, date_col: str = "received_date") -> DataFrame:
    """Both sides have dates and every training date precedes every test date."""
    one = df.agg(
        F.max(F.when(F.col("split") == "train", F.col(date_col))).alias("last_train_date"),
        F.min(F.when(F.col("split") == "test", F.col(date_col))).alias("first_test_date"),
        F.count(F.lit(1)).cast("bigint").alias("row_count"),
    )
    return one.withColumn("passed", F.coalesce(F.col("last_train_date") < F.col("first_test_date"), F.lit(False)))


def shares_sum_to_one(seg: DataFrame, tol: float = 1e-6) -> DataFrame:
    """C11: both share columns sum to 1 within each feature; an empty input is one failed row."""
    g = seg.groupBy("feature_name").agg(
        F.sum("portfolio_loan_share").alias("total_loan_share"),
        F.sum("portfolio_positive_loss_share").alias("total_positive_loss_share"),
    )
    ok = F.coalesce(
        (F.abs(F.col("total_loan_share") - 1) <= tol) & (F.abs(F.col("total_positive_loss_share") - 1) <= tol),
        F.lit(False),
    )
    judged = g.withColumn("passed", ok)
    nothing = seg.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        *[F.lit(None).cast(judged.schema[c].dataType).alias(c) for c in judged.columns[:-1]], F.lit(False).alias("passed")
    )
    return judged.unionByName(nothing)


def band_shares_sum_to_one(bands: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Both band share columns sum to 1."""
    one = bands.agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"),
        F.sum("positive_loss_loan_share").alias("total_loan_share"),
        F.sum("positive_loss_amount_share").alias("total_amount_share"),
    )
    ok = (F.col("row_count") > 0) & F.coalesce(
        (F.abs(F.col("total_loan_share") - 1) <= tol) & (F.abs(F.col("total_amount_share") - 1) <= tol), F.lit(False)
    )
    return one.withColumn("passed", ok)


def yearly_reconciles(yearly: DataFrame, joined: DataFrame, date_col: str = "received_date", label_col: str = "is_loss") -> DataFrame:
    """C13 (J8): yearly mart totals equal the dated source rows and losses."""
    m = yearly.agg(
        F.sum("funded_loan_count").cast("bigint").alias("mart_loans"),
        F.sum("loss_loan_count").cast("bigint").alias("mart_losses"),
    )
    s = joined.where(F.col(date_col).isNotNull()).agg(
        F.count(F.lit(1)).cast("bigint").alias("source_loans"),
        F.sum(F.col(label_col).cast("int")).cast("bigint").alias("source_losses"),
    )
    packed = s.select(F.struct("source_loans", "source_losses").alias("s")).scalar()
    r = m.select("*", packed.alias("s")).select("mart_loans", "s.source_loans", "mart_losses", "s.source_losses")
    ok = F.col("mart_loans").eqNullSafe(F.col("source_loans")) & F.col("mart_losses").eqNullSafe(F.col("source_losses"))
    return r.withColumn("passed", ok & (F.col("source_loans") > 0))


def no_group_straddles_split(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """C14: there are rows, and no duplicate feature vector has rows in both train and test."""
    found = repeats(df, list(feature_cols), [(F.min("split") != F.max("split")).alias("straddles")])
    one = found.groups.agg(
        (F.count(F.lit(1)) + F.lit(found.single)).alias("groups"),
        F.count_if(F.col("n") > 1).cast("bigint").alias("duplicate_groups"),
        F.count_if("straddles").cast("bigint").alias("straddling_groups"),
    )
    return one.withColumn("passed", (F.col("groups") > 0) & (F.col("straddling_groups") == 0))
