"""Quality classifier: a factorisation machine over hashed words and statistics.

The score of features x is ``sigmoid(w0 + w.x + sum_{i<j} <v_i, v_j> x_i x_j)``.
The pairwise sum is computed in linear time as half of
``sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.

Features are the words of the text (hashed, square-root counts scaled to unit
length), structure statistics, and the row's ``n_chars`` as metadata.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, text_bytes, with_columns
from lendlake.llm.common import text_or_empty
from lendlake.llm.quality_rules import WordHash, text_counts

WORD_BUCKETS = 1 << 14
STATISTICS = 12
FACTORS = 8
SAMPLE_ROWS = 4096

_HASH = WordHash()


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices (statistics first, then words) and values of one row."""
    n, chars, symbols, dup_lines, repeated = text_counts(text)
    words = text.split()
    per_word, per_char = 1 / max(1, n), 1 / max(1, chars)
    lines = text.count(b"\n") + 1
    decoded = text.decode()
    upper = sum(map(text.count, (bytes([c]) for c in range(65, 91))))
    digits = sum(map(text.count, (bytes([c]) for c in range(48, 58))))
    stats = np.array(
        [
            np.log1p(n) / 8,
            chars * per_word / 8,
            symbols * per_word,
            dup_lines / lines,
            repeated * per_word,
            len(set(words)) * per_word,
            upper * per_char,
            digits * per_char,
            (text.count(b"!") + text.count(b"?")) * per_word,
            (text.count(b".") + text.count(b",")) * per_word,
            lines * per_word,
            np.log1p(max(0, len(decoded) if n_chars is None else n_chars)) / 10,
        ]
    )
    if not n:
        return np.arange(STATISTICS), stats
    bucket, count = np.unique(_HASH(words) % WORD_BUCKETS, return_counts=True)
    value = np.sqrt(count)
    return (
        np.concatenate([np.arange(STATISTICS), bucket + STATISTICS]),
        np.concatenate([stats, value / np.sqrt(value @ value)]),
    )


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        part = self.factors[index] * value[:, None]
        total = part.sum(axis=0)
        z = self.bias + self.linear[index] @ value + 0.5 * (total @ total - (part * part).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]], factors: int = FACTORS, epochs: int = 12, batch: int = 128,
    rate: float = 0.02, decay: float = 1e-5, seed: int = 7,
) -> FactorisationMachine:
    """Logistic loss, Adam on minibatches; the same rows give the same model.

    Without rows, or with one class only, the model is a smoothed constant.
    """
    width, rng = STATISTICS + WORD_BUCKETS, np.random.default_rng(seed)
    share = (sum(y for _, _, y in rows) + 1) / (len(rows) + 2)
    start = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(width), np.zeros((width, factors)))
    if len({y for _, _, y in rows}) < 2:
        return start
    # One matrix of parameters: column 0 is linear, the rest are factors; a last row for the bias.
    p = np.concatenate([np.zeros((width, 1)), rng.normal(0, 0.05, (width, factors))], axis=1)
    m, s, bias, bm, bs, step = np.zeros_like(p), np.zeros_like(p), start.bias, 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            index = np.concatenate([r[0] for r in part])
            value = np.concatenate([r[1] for r in part])[:, None]
            ends = np.cumsum([0] + [len(r[0]) for r in part[:-1]])
            row = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            y = np.array([r[2] for r in part], float)
            own = p[index] * value
            sums = np.add.reduceat(own, ends)
            squares = np.add.reduceat((own[:, 1:] ** 2).sum(axis=1), ends)
            z = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(part)
            slope = np.empty_like(own)
            slope[:, 0] = value[:, 0]
            slope[:, 1:] = value * (sums[row, 1:] - own[:, 1:])
            used, to = np.unique(index, return_inverse=True)
            by = np.argsort(to, kind="stable")
            starts = np.searchsorted(to[by], np.arange(len(used)))
            grad = np.add.reduceat((slope * error[row][:, None])[by], starts) + decay * p[used]
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * grad
            s[used] = 0.999 * s[used] + 0.001 * grad**2
            bm, bs = 0.9 * bm + 0.1 * error.sum(), 0.999 * bs + 0.001 * error.sum() ** 2
            a, b = 1 - 0.9**step, 1 - 0.999**step
            p[used] -= rate * (m[used] / a) / (np.sqrt(s[used] / b) + 1e-8)
            bias -= rate * (bm / a) / (np.sqrt(bs / b) + 1e-8)
    return FactorisationMachine(float(bias), p[:, 0].copy(), p[:, 1:].copy())


def _n_chars(docs: DataFrame, n_chars: str):
    return F.col(f"`{n_chars}`").cast("long") if n_chars in docs.columns else F.lit(None).cast("long")


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, n_chars: str, sample_rows: int
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features of at most ``sample_rows`` labelled documents, chosen by a hash of their id."""
    known = labels.filter(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    known = known.groupBy(F.col(f"`{doc_id}`").alias("id")).agg((F.avg(f"`{label}`") >= 0.5).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), text_or_empty(text).alias("text"), _n_chars(docs, n_chars).alias("n_chars"))
    rows = rows.join(F.broadcast(chosen), "id")
    schema = "id bigint, y int, place binary, value binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            x = [features(t, n) for t, n in zip(text_bytes(batch.column("text")), batch.column("n_chars").to_pylist())]
            more = {
                "place": pa.array([i.astype("<i4").tobytes() for i, _ in x], pa.binary()),
                "value": pa.array([v.astype("<f8").tobytes() for _, v in x], pa.binary()),
            }
            out = with_columns(batch, ["text", "n_chars"], more)
            yield out.select(["id", "y", "place", "value"])

    # Of several rows with one id, one stays: the bound holds for the driver too.
    one = map_batches(rows, run, schema).groupBy("id").agg(F.min(F.struct("place", "value", "y")).alias("r"))
    found = one.orderBy(F.xxhash64("id"), "id").collect()
    return [(np.frombuffer(r["r"]["place"], "<i4"), np.frombuffer(r["r"]["value"], "<f8"), r["r"]["y"]) for r in found]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    n_chars: str = "n_chars", sample_rows: int = SAMPLE_ROWS,
) -> FactorisationMachine:
    """Fit on a bounded sample of ``labels`` (``doc_id``, ``label`` 0 or 1).

    Null labels and ids and ids that ``docs`` lacks are ignored; several labels
    of one id vote.  The sample, ``sample_rows`` at most, goes to the driver.
    """
    return fit(training_rows(docs, labels, label, doc_id, text, n_chars, sample_rows))


def score(
    docs: DataFrame, model: FactorisationMachine, text: str = "text", n_chars: str = "n_chars", out: str = "score"
) -> DataFrame:
    """``docs`` with ``out``, from 0 to 1; the text column goes.

    Whole texts, row by row: null counts as empty, and an empty text is scored
    by its statistics.  Repeated rows get equal scores.  A missing ``n_chars``
    column or value is replaced by the length of the text.  A column named
    ``out`` is replaced; others pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    meta = "n_chars for score"
    rows = docs.withColumn(meta, _n_chars(docs, n_chars))
    drop = [text, meta, out]
    schema = replaced_schema(docs, drop, T.StructField(out, T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in by_bytes(batches, text):
            lengths = batch.column(meta).to_pylist()
            values = [machine.score(*features(t, n)) for t, n in zip(text_bytes(batch.column(text)), lengths)]
            yield with_columns(batch, drop, {out: pa.array(values, pa.float64())})

    return map_batches(rows, run, schema)
