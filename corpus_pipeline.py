"""A training corpus from raw documents, in five stages.

Quality rules, exact deduplication, near-duplicate removal, removal of
repeated passages, packing.  Each stage works on all that its predecessor
kept, which is written as Parquet and read back in between, so an executor or
a whole run lost costs one stage.  The first four return the columns of
``documents``; the last returns packed pieces.

Null and empty texts fail the quality rules.  Repeated rows count as exact
copies.  Columns beside ``doc_id``, ``text`` and ``n_chars`` pass unchanged;
``n_chars`` follows the text where passages are cut out.  An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.llm import exact_dedup, packing, quality_rules, simhash, suffix_dedup, word_tokens
from lendlake.llm.common import keep_rows, stored, table
from lendlake.llm.queries import WORDS


def others_aside(stage: Callable) -> Callable:
    """``stage`` with the caller's other columns under names that no operator uses."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = ("doc_id", "text", "n_chars")
        names = [c.lower() if c.lower() in own else f"other column {i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    return run


@others_aside
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject; documents labelled 1 are the trusted target."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_rules.apply_rules(docs, good).filter("kept").select(*docs.columns)


@others_aside
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, against a new digest index."""
    with exact_dedup.DigestIndex(spark, expected=docs.count()) as index:
        found = exact_dedup.dedup_exact(docs, index)
    return keep_rows(docs, found.filter("kept"))


@others_aside
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links."""
    found = simhash.near_duplicates(docs, shingle=4, radius=4)
    return keep_rows(docs, found.filter("kept"))


@others_aside
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out 100-byte strings that also start earlier, whole characters only."""
    cut = suffix_dedup.remove_repeats(docs, window=100, whole_characters=True)
    text = F.col("kept").cast("string")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, each document closed by id 0."""
    tokens = word_tokens.encode(docs.select("doc_id", "text"), WORDS, end_id=0)
    pieces = packing.cut(tokens, 2048)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow, 2048)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("suffix-array dedup", passages),
    ("best-fit packing", pack),
]

# The third stage joins by Hamming distance and the fourth follows bytes: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
