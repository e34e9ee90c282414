"""Uniform sharding by a hypergeometric communication matrix.

A uniform shuffle of N rows into shards of fixed sizes sends a random number
of rows from every input partition to every shard.  These numbers follow the
multivariate hypergeometric law, so they are drawn first, exactly: row p of
the matrix sums to the rows of partition p, column s to the size of shard s.
Then each partition permutes its rows and deals them out by its row of the
matrix, the rows are exchanged, and each shard permutes what it got.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.common import stored, without


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good, for any sizes.

    Inverts the distribution function over the mode plus and minus twelve
    standard deviations (what lies beyond has probability below 1e-30);
    neighbouring probabilities come from their ratio, so no large factorials.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    spread = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    reach = int(12 * spread) + 12
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(mode, b, dtype=np.float64)
    up = np.cumprod(((good - k) / (k + 1)) * ((n - k) / (bad - n + k + 1)))
    k = np.arange(mode, a, -1, dtype=np.float64)
    down = np.cumprod((k / (good - k + 1)) * ((bad - n + k) / (n - k + 1)))
    weights = np.concatenate([down[::-1], [1.0], up])
    cdf = np.cumsum(weights)
    return a + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right").clip(0, len(cdf) - 1))


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows to send from each partition (of ``counts``) to each shard (of ``sizes``)."""
    rng, left, matrix = np.random.default_rng(seed), list(sizes), []
    for n in counts:
        row, rest, take = [], sum(left), n
        for size in left:
            k = draw_hypergeometric(rng, size, rest - size, take)
            row.append(k)
            rest, take = rest - size, take - k
        left = [x - k for x, k in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 42, rows_per_task: int = 250_000) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard).

    Shard sizes differ by one row at most, and every assignment of rows to
    places is equally likely.  All columns travel with the rows, so pass ids
    and what the shards shall hold.

    Rows are stored once with the partition and place they were read at; that
    pair is their identity, so null ids, repeated rows and equal values need no
    care, and a recomputed task sees the same rows.  Columns named ``shard`` or
    ``slot`` are replaced.  An empty table gives no rows.

    Only the number of rows of each input partition goes to the driver (that
    is bounded by the partitions, not the rows), where the matrix is drawn.
    Windows run over one input partition or, in a shard, over about
    ``rows_per_task`` rows: the second permutation orders a shard by a random
    key, so key ranges are sorted apart and placed by their counts.
    """
    spark = df.sparkSession
    source = without(df, ["shard", "slot"])
    names = source.columns
    rows = stored(
        source.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row") if names else F.lit(None).cast("struct<x:int>").alias("row"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "shard-rows",
    )
    counts = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = [(p, [int(x) for x in np.cumsum(row)]) for (p, _), row in zip(counts, matrix)]
    dealt = spark.createDataFrame(ends, "part int, ends array<bigint>")

    permuted = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "place"), "place")
    sent = (
        rows.withColumn("k", F.row_number().over(permuted))
        .join(dealt, "part")
        .select("row", "place", F.size(F.filter("ends", lambda end: end < F.col("k"))).alias("shard"))
    )
    tasks = max(1, -(-max(sizes) // rows_per_task))
    key = F.xxhash64(F.lit(seed + 1), "place")
    sent = stored(
        sent.withColumn("key", key).withColumn("range", F.pmod(F.shiftright("key", 32), F.lit(tasks))),
        "shard-sent",
    )
    per_range = sent.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    again = Window.partitionBy("shard", "range").orderBy("key", "place")
    return (
        sent.withColumn("k", F.row_number().over(again))
        .join(offsets, ["shard", "range"])
        .select(*[F.col("row")[c].alias(c) for c in names], "shard", (F.col("offset") + F.col("k") - 1).alias("slot"))
    )
