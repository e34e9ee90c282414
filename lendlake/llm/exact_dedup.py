"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by the digest of the
normalised text.  A batch is reduced to one row per digest, deduplicated
against the index by sort-merge anti-join (no shuffle of the index side), and
what is new is appended.  Running the same batch again appends nothing, so a
failed run can be repeated.  Only DataFrame operations are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.llm.common import WHITESPACE, join_by_size, scratch_path, stored, text_or_empty

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING"


def normalised(text: Column) -> Column:
    """The text without any white space of the contract."""
    return F.translate(text, WHITESPACE, "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 64, 100_000  # the most that Spark allows


class DigestIndex:
    """Digests seen so far, bucketed and sorted, at ``location``.

    ``location`` must be a folder that all executors share; left out, a new
    folder below ``spark.checkpoint.dir`` is taken.  The number of buckets is
    fixed for the life of an index and kept beside its files: a new one takes
    ``buckets``, or else one for each ``ROWS_PER_BUCKET`` of the ``expected``
    digests; one that is there already keeps its own, and asking for another is
    an error, as is a folder of files without that mark.  ``close`` (or the end
    of a ``with`` block) takes the table out of the catalogue and leaves the files.
    """

    def __init__(self, spark: SparkSession, location: str | None = None, buckets: int | None = None, expected: int = 0):
        self.spark = spark
        self.location = location or scratch_path(spark, "digest-index")
        known = self._known_buckets()
        if known is not None and buckets not in (None, known):
            raise ValueError(f"the index at {self.location} has {known} buckets, not {buckets}")
        wanted = min(max(-(-expected // ROWS_PER_BUCKET), LEAST_BUCKETS), MOST_BUCKETS)
        self.buckets = known or buckets or wanted
        self.name = f"digest_index_{uuid.uuid4().hex}"
        if known is None:
            spark.range(1).select(F.lit(str(self.buckets)).alias("value")).coalesce(1).write.text(self._mark)
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )

    @property
    def _mark(self) -> str:
        return f"{self.location.rstrip('/')}/_buckets"  # Spark's readers pass over names that begin so

    def _known_buckets(self) -> int | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.location)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path) or not files.listStatus(path):
            return None
        if not files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._mark}/_SUCCESS")):
            raise ValueError(f"{self.location} holds files, but no number of buckets")
        return int(self.spark.read.text(self._mark).first()["value"])

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        return groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id", "keep_row", "batch")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def dedup_exact(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Deduplicate a batch and add its new digests to ``index``.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, row_hash``.  Of equal texts in the batch the row with the
    most code points, then the smallest id (null ids last), then the first
    row read stays, unless an earlier batch holds the text already: then no
    row of this batch is kept and ``keep_id`` is the earlier one.
    ``group_size`` counts the rows of this batch; ``row_hash`` is
    ``xxhash64(text)`` and tells rows of one id apart.

    Null text counts as empty, and all texts of white space only are equal.
    Repeated rows are members of one group, of which one stays.  An empty
    table gives no rows.  Columns other than the two named are not read.

    The text is read once, for the digest; what is shuffled is 32 bytes of
    digest and three numbers a row.  Groups are reduced before the shuffle and
    large groups are not shuffled back (``join_by_size``).
    """
    batch = uuid.uuid4().hex
    source = text_or_empty(text)
    rows = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.length(source).alias("n_chars"),
            digest(source).alias("digest"),
            F.xxhash64(source).alias("row_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    first = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = stored(rows.groupBy("digest").agg(first.alias("best"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
    index.append(
        index.unseen(groups).select(
            "digest",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            F.lit(batch).alias("batch"),
        )
    )
    entries = stored(
        index.table().hint("merge").join(groups.select("digest", "group_size"), "digest"),
        "digest-entries",
    )
    found = join_by_size(rows, entries, "digest", "group_size", rows.count())
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("batch") == batch) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row_hash",
    )
