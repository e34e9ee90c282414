"""Exact quantiles by repeated rank selection, with bounded memory per task.

Spark's exact ``percentile`` keeps a value -> count map per group and merges
all of them for a group in one task; for a global median over a huge table
that map holds every distinct amount.  Here the rank is *selected*:

1. per group, a bounded ``percentile_approx`` sketch brackets the middle
   ranks: [q(p - m), q(p + m)] with a margin m of a few times the sketch error;
2. one pass counts the rows below the bracket and reduces the rows inside it
   to (value, count): ties collapse before the shuffle, so a value held by a
   third of a group is one row a task;
3. a bracket that holds at most ``SMALL_BRACKET`` distinct values is finished:
   a window over them accumulates counts, and the values covering the two ranks
   around the position give the result;
4. any other bracket is narrowed and goes through 2. again: a larger one to the
   cells of a grid of its values between which the ranks lie, by exact counts;
   one that missed a rank is opened on the side where the rank lies.

So no task ever orders more than ``SMALL_BRACKET`` values of a group, whatever
the sketch says, and the result is always exact.  The per-group statistics are
stored, counted and broadcast only up to ``BROADCAST_MAX_GROUPS``; with more
groups the joins stay shuffle joins.  Decimal inputs keep the decimal
convention of the marts: the midpoint of the two middle values is truncated
toward zero to the input scale.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lendlake.session import stored

DEFAULT_ACCURACY = 10000
# Per-group statistics are broadcast up to this many groups; beyond it the
# plan keeps shuffle joins.
BROADCAST_MAX_GROUPS = 200_000
SMALL_BRACKET = 20_000  # distinct values that one task orders
GRID = 1000  # cells that a larger bracket is cut into


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "median", accuracy: int = DEFAULT_ACCURACY
) -> DataFrame:
    """One row per group of ``keys`` (one row overall for no keys) with the exact median.

    Decimal inputs return the input decimal type with the midpoint of the two
    middle values truncated toward zero at the input scale.
    """
    vtype = df.schema[value].dataType
    q = exact_quantiles(df, keys, value, [0.5], "__q", accuracy)
    m = F.col("__q")[0]
    if isinstance(vtype, DecimalType):
        factor = 10**vtype.scale
        m = (
            (m.cast(f"decimal({vtype.precision + 4},{vtype.scale + 2})") * F.lit(factor)).cast("bigint") / F.lit(factor)
        ).cast(f"decimal({vtype.precision},{vtype.scale})")
    return q.select(*list(keys), m.alias(out))


def nan_count(df: DataFrame, keys: Sequence[str], value: str, out: str = "nan_count") -> DataFrame:
    """How many values of each group the quantiles leave out because they are NaN."""
    return df.groupBy(*keys).agg(F.count_if(F.isnan(F.col(value).cast("double"))).alias(out))


def _bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_GROUPS, small: bool | None = None) -> tuple[DataFrame, bool]:
    """Broadcast a per-group table only behind a size check (stored, counted).

    ``small`` reuses an earlier check for a table with the same groups.
    """
    df = stored(df, "quantiles")
    if small is None:
        small = df.count() <= max_rows
    return (F.broadcast(df) if small else df), small


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    out: str = "quantiles",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Exact interpolated quantiles (position (n-1)p, linear) by selection.

    Returns ``keys + [out]`` with ``out`` an array<double> in ``probs`` order
    (one row for no keys, NULLs on empty input).  NULL and NaN values are no
    observations and are left out; ``nan_count`` reports how many NaN there
    are.  A row is routed to the
    brackets that contain it (at most ``len(probs)`` copies of the bracket rows
    only).
    """
    keys, probs = list(keys), [float(p) for p in probs]
    P = len(probs)
    g = keys or ["__g"]
    v = df.select(*[F.col(k) for k in keys], F.col(value).cast("double").alias("__v"))
    if not keys:
        v = v.withColumn("__g", F.lit(0))
    v = v.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    m = 3.0 / accuracy
    stats = v.groupBy(*g).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", [max(0.0, p - m) for p in probs] + [min(1.0, p + m) for p in probs], accuracy).alias("__b"),
    )
    pos = [(F.col("__n") - 1) * F.lit(p) for p in probs]
    stats = stats.select(
        *g,
        "__n",
        F.array(*[F.col("__b")[i] for i in range(P)]).alias("__lo"),
        F.array(*[F.col("__b")[P + i] for i in range(P)]).alias("__hi"),
        F.array(*[(F.floor(x) + 1).cast("bigint") for x in pos]).alias("__kl"),
        F.array(*[(F.ceil(x) + 1).cast("bigint") for x in pos]).alias("__kh"),
        F.array(*pos).alias("__pos"),
    )
    brackets, small, found = stats.withColumn("__id", F.array(*[F.lit(i) for i in range(P)])), None, []
    while True:
        brackets, small = _bounded(brackets, small=small)  # the groups of later rounds are among those of the first
        values, state = _look(v, brackets, g, P)
        found.append(_picked(values, state.where("__ready"), g))
        rest = state.where(~F.col("__ready"))
        if rest.isEmpty():
            break
        brackets = _narrowed(values, rest, g)
    picked = reduce(DataFrame.unionByName, found)
    per_group = picked.groupBy(*g).agg(F.sort_array(F.collect_list(F.struct("__i", "__x"))).alias("__s"))
    res = per_group.select(*g, F.transform("__s", lambda s: s["__x"]).alias(out))
    if not keys:
        return df.sparkSession.range(1).select(res.select(out).scalar().alias(out))
    return res


def _look(v: DataFrame, brackets: DataFrame, g: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """One pass: the distinct values in every bracket with their counts, and per bracket what is known of it.

    ``brackets`` has arrays per group (``__id, __lo, __hi, __kl, __kh, __pos``),
    ``most`` entries at most.  ``__ready``: the bracket holds both ranks and few
    enough values.
    """
    j = v.join(brackets, g)
    inside = [F.col("__v").between(F.get("__lo", F.lit(i)), F.get("__hi", F.lit(i))) for i in range(most)]
    counts = j.groupBy(*g).agg(
        F.array(*[F.count_if(F.col("__v") < F.get("__lo", F.lit(i))) for i in range(most)]).alias("__below"),
        F.array(*[F.count_if(c) for c in inside]).alias("__within"),
    )
    routed = j.select(*g, "__v", F.explode(F.array_compact(F.array(*[F.when(c, F.get("__id", F.lit(i))) for i, c in enumerate(inside)]))).alias("__i"))
    values = stored(routed.groupBy(*g, "__i", "__v").agg(F.count(F.lit(1)).alias("__c")), "quantile-values")
    parts = ["__id", "__lo", "__hi", "__kl", "__kh", "__pos", "__below", "__within"]
    long = brackets.join(counts, g).select(*g, F.explode(F.slice(F.arrays_zip(*parts), 1, F.size("__id"))).alias("b")).select(*g, "b.*")
    sizes = values.groupBy(*g, "__i").agg(F.count(F.lit(1)).alias("__m"))
    state = long.withColumnRenamed("__id", "__i").join(sizes, [*g, "__i"], "left")
    holds = (F.col("__below") < F.col("__kl")) & (F.col("__below") + F.col("__within") >= F.col("__kh"))
    ready = holds & (F.coalesce("__m", F.lit(0)) <= SMALL_BRACKET)
    return values, stored(state.withColumns({"__holds": holds, "__ready": ready}), "quantile-state")


def _picked(values: DataFrame, state: DataFrame, g: list[str]) -> DataFrame:
    """``__i, __x`` per group: the interpolated value of finished brackets."""
    w = Window.partitionBy(*g, "__i").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.join(state, [*g, "__i"]).withColumn("__top", F.sum("__c").over(w) + F.col("__below"))
    # Ranks covered by this value: (top - c, top].
    covers = lambda k: (F.col("__top") - F.col("__c") < F.col(k)) & (F.col(k) <= F.col("__top"))
    hits = ranked.where(covers("__kl") | covers("__kh")).groupBy(*g, "__i").agg(
        F.max(F.when(covers("__kl"), F.col("__v"))).alias("__a"),
        F.max(F.when(covers("__kh"), F.col("__v"))).alias("__z"),
        *[F.first(c).alias(c) for c in ("__kl", "__kh", "__pos")],
    )
    between = (F.col("__kh") - 1 - F.col("__pos")) * F.col("__a") + (F.col("__pos") - (F.col("__kl") - 1)) * F.col("__z")
    return hits.select(*g, "__i", F.when(F.col("__kl") == F.col("__kh"), F.col("__a")).otherwise(between).alias("__x"))


def _narrowed(values: DataFrame, rest: DataFrame, g: list[str]) -> DataFrame:
    """The next brackets of those that are not finished."""
    keys = [*g, "__i"]
    keep = [*keys, "__kl", "__kh", "__pos"]
    # A missed rank: open the side on which it lies.
    missed = rest.where(~F.col("__holds")).select(
        *keep,
        F.when(F.col("__below") < F.col("__kl"), F.col("__lo")).otherwise(F.lit(float("-inf"))).alias("__lo"),
        F.when(F.col("__below") + F.col("__within") >= F.col("__kh"), F.col("__hi")).otherwise(F.lit(float("inf"))).alias("__hi"),
    )
    # Too many values: count the rows up to each edge of a grid.
    wide = rest.where("__holds")
    inner = values.join(wide.select(*keys), keys, "left_semi")
    grid = inner.groupBy(*keys).agg(F.percentile_approx("__v", [i / GRID for i in range(1, GRID + 1)], DEFAULT_ACCURACY).alias("__edges"))
    cells = inner.join(grid, keys).select(*keys, "__c", F.filter("__edges", lambda e: e >= F.col("__v"))[0].alias("__edge"))
    per_cell = cells.groupBy(*keys, "__edge").agg(F.sum("__c").alias("__c"))
    upto = Window.partitionBy(*keys).orderBy("__edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = per_cell.withColumn("__top", F.sum("__c").over(upto)).join(wide.select(*keep, "__below", F.col("__lo").alias("__from")), keys)
    top = F.col("__top") + F.col("__below")
    cut = ranked.groupBy(*keep).agg(
        F.coalesce(F.max(F.when(top < F.col("__kl"), F.col("__edge"))), F.max("__from")).alias("__lo"),
        F.min(F.when(top >= F.col("__kh"), F.col("__edge"))).alias("__hi"),
    )
    every = missed.unionByName(cut)
    one = F.struct(F.col("__i").alias("__id"), "__lo", "__hi", "__kl", "__kh", "__pos")
    grouped = every.groupBy(*g).agg(F.sort_array(F.collect_list(one)).alias("b"))
    return grouped.select(*g, *[F.transform("b", _field(c)).alias(c) for c in ("__id", "__lo", "__hi", "__kl", "__kh", "__pos")])


def _field(name: str):
    return lambda x: x[name]
