"""Repeated records by digest.

Rows are first counted by a digest of 16 bytes, so that is what a row costs in
the shuffle, however wide it is.  Only rows whose digest occurs again are
compared by their columns; a digest that different rows share therefore
changes nothing but the work.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lendlake.session import stored

MAX_BROADCAST_DIGESTS = 2_000_000  # 16 bytes each


def row_digest(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the values and of which of them are NULL; 0.0 and -0.0 are equal."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    values = [F.col(c) + 0.0 if c in floats else F.col(c) for c in columns]
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(1), *values, missing), F.xxhash64(F.lit(2), missing, *reversed(values))


@dataclass
class Repeats:
    """``groups``: the columns and ``n`` of all rows whose digest is repeated; ``single`` other rows, of ``total``."""

    groups: DataFrame
    single: int
    total: int


def repeats(df: DataFrame, columns: Sequence[str], more: Sequence[Column] = (), digest: tuple[Column, Column] | None = None) -> Repeats:
    """Groups of equal rows (NULLs equal), with ``more`` aggregates of each; a group of one is possible where digests collide."""
    first, second = digest or row_digest(df, columns)
    keyed = df.withColumns({"__d1": first, "__d2": second})
    seen = Observation()
    counts = keyed.groupBy("__d1", "__d2").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.observe(seen, F.count_if(F.col("n") == 1).alias("single"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    again = stored(counts.where("n > 1").select("__d1", "__d2"), "repeated-digests")
    side = F.broadcast(again) if again.count() <= MAX_BROADCAST_DIGESTS else again
    rows = keyed.join(side, ["__d1", "__d2"], "left_semi")
    return Repeats(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), *more), int(seen.get["single"]), int(seen.get["total"]))
