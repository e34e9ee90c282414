"""Quality rules: counts of a text, and a hashed n-gram likelihood ratio.

A trusted target and the raw corpus each give counts of hashed words and word
pairs (all documents counted).  The target's share of a bucket is smoothed
towards the raw share: a bucket's ratio is (target count + PRIOR) : (count
expected of a raw text of the target's size + PRIOR), so an n-gram without
evidence either way scores 0, however few texts are trusted.  A document's
score is the mean over its n-grams of the log ratio.  A trusted document's own
n-grams are taken out of the target when it is scored, so its verdict is the
one it would get if it were not trusted.  Every document is held against one
threshold; nothing is drawn at random.

Log ratios are rounded to millionths, so a document's sum is a whole number:
the verdict does not depend on the order of summing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, text_bytes, with_columns
from lendlake.llm.common import WHITESPACE

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

BUCKETS = 1 << 16
PAIR_FACTOR = 1_000_003
THRESHOLD = -150_000  # millionths of a nat per n-gram
PRIOR = 8  # n-grams per bucket that follow the raw corpus
TRUSTED_BROADCAST_ROWS = 250_000  # 8 bytes each; more are joined by shuffle
MEMO_ENTRIES = 300_000

MARK = "trusted mark"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class WordHash:
    """The first four bytes of a word's MD5, memoised per worker."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MEMO_ENTRIES:
            known.clear()
        found = list(map(known.get, words))
        if None in found:
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    found[i] = known[w] = int.from_bytes(md5(w).digest()[:4], "big")
        return np.array(found, np.int64)


_HASH = WordHash()


def buckets_of(words: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of all words and of all pairs of neighbours, repeats included."""
    h = _HASH(words)
    return np.concatenate([h % buckets, (h[:-1] * PAIR_FACTOR + h[1:]) % buckets])


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in windows of ``REPEAT_WINDOW`` words that are found twice or more.

    Windows are compared by 64-bit hashes, eight bytes a window whatever the text's length.
    """
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    word = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = word[:n].copy()
    for i in range(1, REPEAT_WINDOW):
        window = window * np.uint64(0x9E3779B97F4A7C15) + word[i : i + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    edges[starts] += 1
    edges[starts + REPEAT_WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows)."""
    words = text.split()
    chars = len(text.decode()) - sum(text.count(c.encode()) for c in WHITESPACE)
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def count_buckets(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """``bucket, n, t``: n-grams of all and of the marked texts by bucket, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in by_bytes(batches, text):
            found: dict[bool, list[np.ndarray]] = {True: [], False: []}
            for x, marked in zip(text_bytes(batch.column(text)), batch.column(MARK).to_pylist()):
                if words := x.split():
                    found[marked].append(buckets_of(words, buckets))
            for marked, grams in found.items():
                if grams:
                    counts = np.bincount(np.concatenate(grams), minlength=buckets)
                    total += counts
                    if marked:
                        target += counts
        used = np.flatnonzero(total)
        values = [pa.array(used, pa.int64()), pa.array(total[used]), pa.array(target[used])]
        yield pa.RecordBatch.from_arrays(values, names=["bucket", "n", "t"])

    partial = map_batches(docs.select(F.col(f"`{text}`"), MARK), run, "bucket bigint, n bigint, t bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def log_ratios(target: np.ndarray, size: int, raw: np.ndarray, raw_size: int, prior: float) -> np.ndarray:
    """Log ratios in millionths of buckets with these counts, of ``size`` and ``raw_size`` n-grams in all."""
    expected = size * (raw / max(1, raw_size))
    return np.rint(1e6 * (np.log(target + prior) - np.log(expected + prior))).astype(np.int64)


def mark_trusted(docs: DataFrame, trusted: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` with ``MARK``: whether the id is in ``trusted``; broadcast only behind a count."""
    key = F.col(f"`{doc_id}`")
    ids = trusted.select(key.alias("trusted id")).filter(F.col("trusted id").isNotNull()).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
        return rows.join(ids, key == F.col("trusted id"), "left").select(*columns, F.col("trusted id").isNotNull().alias(MARK))

    if ids.count() <= TRUSTED_BROADCAST_ROWS:
        return marked(docs, F.broadcast(ids))
    # Null ids are never trusted; in the shuffle they would all go to one task.
    return marked(docs.filter(key.isNotNull()), ids).union(docs.filter(key.isNull()).select(*columns, F.lit(False).alias(MARK)))


def apply_rules(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    threshold: int = THRESHOLD,
    prior: float = PRIOR,
) -> DataFrame:
    """``docs`` with the five counts, ``score_sum``, ``n_grams``, ``base_failed`` and ``kept``.

    ``trusted`` lists the ids of the target documents; null ids and ids that
    ``docs`` lacks are ignored, a repeated id counts once.  ``score_sum`` is in
    millionths; a row is kept if it passes the base rules and ``score_sum >=
    threshold * n_grams``.  For a trusted row the target is the other trusted
    texts.  Null and empty texts have no words and fail the base rules.
    Without any trusted text all ratios are 0, so the base rules decide.  Rows
    are judged alone: repeated rows and ties get equal verdicts.
    Columns named like the results are replaced; an empty table stays empty.
    """
    marked_docs = mark_trusted(docs, trusted, doc_id)
    target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for row in count_buckets(marked_docs, text, buckets).collect():  # at most ``buckets`` rows
        target[row["bucket"]], raw[row["bucket"]] = row["t"], row["n"]
    size, raw_size = int(target.sum()), int(raw.sum())
    weights = log_ratios(target, size, raw, raw_size, prior)
    known = docs.sparkSession.sparkContext.broadcast((target, raw, weights))
    outputs = [*COUNTS, "score_sum", "n_grams", "base_failed", "kept"]
    fields = [T.StructField(c, T.LongType()) for c in outputs[:-2]] + [T.StructField(c, T.BooleanType()) for c in outputs[-2:]]
    schema = replaced_schema(docs, outputs, *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw, weights = known.value

        def score_sum(grams: np.ndarray, marked: bool) -> int:
            if not marked:
                return int(weights[grams].sum())
            own, n = np.unique(grams, return_counts=True)
            return int((n * log_ratios(target[own] - n, size - len(grams), raw[own], raw_size, prior)).sum())

        for batch in by_bytes(batches, text):
            rows = []
            for x, marked in zip(text_bytes(batch.column(text)), batch.column(MARK).to_pylist()):
                counts = text_counts(x)
                n, _, _, _, repeated = counts
                words = x.split()
                grams = buckets_of(words, buckets) if words else ()
                score = score_sum(grams, marked) if words else 0
                failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
                rows.append((*counts, score, len(grams), failed, not failed and score >= threshold * len(grams)))
            kinds = [pa.int64()] * (len(outputs) - 2) + [pa.bool_()] * 2
            values = {c: pa.array(v, k) for c, v, k in zip(outputs, zip(*rows), kinds)}
            yield with_columns(batch, [*outputs, MARK], values)

    return map_batches(marked_docs, run, schema)
