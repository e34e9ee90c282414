"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.session import checkpoint_dir

# Fixed value: the white space of the result contracts, `[\x20\x09-\x0D]`.
WHITESPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Folders are grouped by application, so they can be removed once it ends.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lendlake-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, and every
    consumer sees the same rows even if the plan above is not deterministic.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the input columns that an operator is about to produce."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_or_empty(column: str | Column) -> Column:
    c = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def join_by_size(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, parts: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with the one-row-per-key table ``groups``.

    Keys that hold more than ``total / parts`` rows are at most ``parts`` many,
    so that table is broadcast and their rows stay where they are.  All other
    keys meet by sort-merge join, where no key is large.
    """
    limit = total / parts
    hot = groups.filter(F.col(size) > limit)
    light = groups.filter(F.col(size) <= limit)
    at_hot = rows.join(F.broadcast(hot), key)
    at_light = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(light.hint("merge"), key)
    return at_hot.unionByName(at_light)


def keep_rows(docs: DataFrame, kept: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by ``doc_id`` and ``row_hash`` (``xxhash64(text)``).

    Of repeated rows (same id, same text) one stays: each task keeps one before
    the shuffle, so a row that is repeated often is one row a task.  Null ids
    match null ids.  The text is shuffled once; the rows named are narrow.
    """
    mark, key = "row hash", "row key"
    no_id = F.lit(-(1 << 63))
    named = kept.select(
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias(key), F.col("row_hash").alias(mark)
    ).distinct()
    rows = docs.withColumn(key, F.coalesce(F.col(f"`{doc_id}`").cast("long"), no_id)).withColumn(mark, F.xxhash64(text_or_empty(text)))
    return rows.dropDuplicates([key, mark]).join(named, [key, mark], "left_semi").drop(key, mark)


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``place``: 0, 1, 2, ... over all rows in ascending ``order`` (nulls first).

    Rows are dealt by ranges of the order and sorted there, so no task holds
    more than its range; only the number of rows of each range goes to the
    driver.  Rows that agree in all of ``order`` take neighbouring places;
    a random last key deals them out over ranges, so a row that is repeated
    often does not fill one task.  The result is a written table.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{c}`") for c in order] + [F.col("tie key")]
    ranged = df.withColumn("tie key", F.rand(7)).repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    # The id is the number of the range, shifted by 33 bits, plus the place in it.
    rows = stored(ranged.drop("tie key").withColumn("place", F.monotonically_increasing_id()), label)
    per_range = rows.groupBy(F.shiftright("place", 33).alias("range")).agg(F.count(F.lit(1)).alias("n"))
    first, offsets = 0, []
    for r in sorted(per_range.collect()):
        offsets.append((r["range"], first - (r["range"] << 33)))
        first += r["n"]
    shift = F.broadcast(spark.createDataFrame(offsets, "range bigint, shift bigint"))
    return rows.join(shift, F.shiftright("place", 33) == F.col("range")).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("place") + F.col("shift")).alias("place")
    )
