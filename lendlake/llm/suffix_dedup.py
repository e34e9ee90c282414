"""Repeated byte windows, found by a depth-limited radix sort of suffixes.

Only suffixes that can repeat to the threshold are ever ordered, and only as
deep as the threshold (``window`` bytes):

1. The first digit of a window is its *anchor*, the least-hashed ``ANCHOR``
   bytes in it.  Equal windows have equal anchors at equal places, so windows
   in a row with one anchor are one *run*, and runs are dealt out by anchor.
   This digit alone decides most of the work: an anchor met once holds no
   repeated window.
2. The next digit is the whole context of a run.  Of equal contexts the first
   stays and all windows of the others are repeated.
3. What is left are anchors met in different contexts: the ends of repeated
   passages.  The first run of each such context fetches its bytes, and its
   windows are ordered by most-significant-digit passes of eight bytes, each
   pass dropping suffixes that are alone in their group, down to the window's
   length.  The groups left are exactly the repeated windows.

Of equal windows the one with the smallest (id, start) stays; the bytes that
the others cover are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, text_bytes, with_columns
from lendlake.llm.common import stored, text_or_empty, without

ANCHOR = 32
CHUNK = 1 << 20  # windows of a long text are taken in chunks of so many starts
GROUP_CONTEXTS = 1 << 14  # contexts of one anchor that a task orders at once
NO_ID = (1 << 63) - 1

_FACTOR = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _scrambled(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def anchored_runs(text: bytes, window: int, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, number of starts) of each run of windows.

    The hash of the anchor's bytes (a rolling polynomial) only deals runs out;
    equality is never concluded from it.
    """
    n = len(text)
    up, down = _powers(max(n, CHUNK + window))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    grams = _scrambled((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    # Order by the upper bits, then by place: leftmost of equals, alike in equal windows.
    low = np.uint64((1 << 24) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = window - anchor + 1
    rows = np.concatenate([keys, np.full(-len(keys) % width, np.uint64((1 << 64) - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: len(keys) - width + 1], ahead[width - 1 : len(keys)])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return grams[(least[first] & low).astype(np.int64)], first, np.diff(first, append=len(least))


def _runs(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, context, uid, place, again``; place packs the first start and the number of starts.

    Of equal contexts in a slice of texts only the first is dealt out by its
    anchor; the others are known to be repeated (``again``) and travel under a
    random key, so a line that stands everywhere does not meet in one task.
    """
    schema = "anchor bigint, context bigint, uid bigint, place bigint, again boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in by_bytes(batches, "text", 2 << 20):
            out: list[list[np.ndarray]] = [[], [], [], []]
            for uid, text in zip(batch.column("uid").to_pylist(), text_bytes(batch.column("text"))):
                for at in range(0, len(text) - window + 1, CHUNK):
                    part = text[at : at + CHUNK + window - 1]
                    anchors, first, count = anchored_runs(part, window)
                    ends = (first + count + (window - 1)).tolist()
                    contexts = [digest(part[a:b]) for a, b in zip(first.tolist(), ends)]
                    out[0].append(anchors.view(np.int64))
                    out[1].append(np.array(contexts, np.uint64).view(np.int64))
                    out[2].append(np.full(len(first), uid, np.int64))
                    out[3].append((first + at) << 8 | count)
            if out[0]:
                anchor, context, uid, place = (np.concatenate(x) for x in out)
                order = np.lexsort((place, uid, context, anchor))
                anchor, context, uid, place = anchor[order], context[order], uid[order], place[order]
                again = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])])
                spread = _scrambled(uid.view(np.uint64) * np.uint64(_FACTOR) + place.view(np.uint64)).view(np.int64)
                columns = [np.where(again, spread, anchor), np.where(again, 0, context), uid, place, again]
                names = ["anchor", "context", "uid", "place", "again"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return map_batches(docs.select("uid", "text"), run, schema)


def _resolve_contexts(runs: DataFrame) -> DataFrame:
    """``uid, place, anchor``: repeated runs (anchor null), and first runs of anchors with several contexts.

    Rows arrive sorted, so a task keeps one row in mind, however many rows
    an anchor or a context has.
    """
    order = ["anchor", "context", "uid", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)  # the last first run, not yet judged
        before = False  # whether the first run before it has the same anchor

        def out(uid: np.ndarray, place: np.ndarray, anchor: np.ndarray | None) -> pa.RecordBatch:
            anchors = pa.nulls(len(uid), pa.int64()) if anchor is None else pa.array(anchor)
            return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(place), anchors], names=["uid", "place", "anchor"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in order])
            known = batch.column("again").to_numpy(zero_copy_only=False).astype(bool)
            if known.any():
                yield out(rows[2, known], rows[3, known], None)
            rows = np.concatenate([held, rows[:, ~known]], axis=1)
            if not rows.shape[1]:
                continue
            keys = rows[:2]
            first = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            later = rows[:, ~first]
            if later.shape[1]:
                yield out(later[2], later[3], None)
            heads = rows[:, first]
            same = heads[0, 1:] == heads[0, :-1]
            several = np.concatenate([[before], same]) | np.concatenate([same, [False]])
            judged = heads[:, :-1][:, several[:-1]]
            if judged.shape[1]:
                yield out(judged[2], judged[3], judged[0])
            held, before = heads[:, -1:], bool(same[-1]) if len(same) else before
        if held.shape[1] and before:
            yield out(held[2], held[3], held[0])

    dealt = runs.repartition("anchor").sortWithinPartitions(*order)
    return map_batches(dealt, run, "uid bigint, place bigint, anchor bigint")


def _packed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with its text compressed before it is shuffled, as ``packed text``."""
    schema = replaced_schema(rows, [text], T.StructField("packed text", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in by_bytes(batches, text):
            packed = pa.array([pack(x) for x in text_bytes(batch.column(text))], pa.binary())
            yield with_columns(batch, [text], {"packed text": packed})

    return map_batches(rows, run, schema)


def _context_bytes(firsts: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``anchor, uid, start, bytes`` of first runs; a text's runs are bounded by its length."""
    runs = firsts.groupBy("uid").agg(F.collect_list(F.struct("anchor", "place")).alias("runs"))
    schema = "anchor bigint, uid bigint, start bigint, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in by_bytes(batches, "packed text", 2 << 20):
            out = []
            for uid, packed, found in zip(*[batch.column(c).to_pylist() for c in ("uid", "packed text", "runs")]):
                text = unpack(packed)
                for r in found:
                    start, count = r["place"] >> 8, r["place"] & 255
                    out.append((r["anchor"], uid, start, text[start : start + count + window - 1]))
            kinds = [pa.int64()] * 3 + [pa.binary()]
            columns = [pa.array(v, k) for v, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "uid", "start", "bytes"])

    return map_batches(texts.join(runs, "uid").select("uid", "packed text", "runs"), run, schema)


def radix_repeats(groups: np.ndarray, texts: list[bytes], uids: np.ndarray, starts: np.ndarray, window: int) -> tuple:
    """Windows of ``texts`` that a smaller (uid, start) of the same group has too.

    Most-significant-digit passes, eight bytes each, to ``window`` bytes.
    Returns (text number, window number in it) of the repeated ones, sorted.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(texts) + bytes(8), np.uint8).astype(np.uint64)
    eight = np.zeros(len(buffer) - 7, np.uint64)
    for i in range(8):
        eight = eight << np.uint64(8) | buffer[i : i + len(eight)]
    counts = sizes - window + 1
    text = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + inner
    group = groups[text]
    depths = [min(d, max(0, window - 8)) for d in range(0, window, 8)]
    for depth in depths:
        digit = eight[at + depth]
        if window < 8:
            digit = digit >> np.uint64(8 * (8 - window))
        order = np.lexsort((digit, group))
        digit, group = digit[order], group[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        number = np.cumsum(new) - 1
        alone = np.bincount(number)[number] == 1
        keep = order[~alone]
        text, inner, at, group = text[keep], inner[keep], at[keep], number[~alone]
        if not len(text):
            break
    order = np.lexsort((starts[text] + inner, uids[text], group))
    text, inner, group = text[order], inner[order], group[order]
    again = np.concatenate([[False], group[1:] == group[:-1]]) if len(group) else np.zeros(0, bool)
    text, inner = text[again], inner[again]
    order = np.lexsort((inner, text))
    return text[order], inner[order]


def _order_windows(contexts: DataFrame, window: int) -> DataFrame:
    """``uid, start, n``: rows of repeated windows in contexts, group by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ordered(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows)
            uids, starts = t["uid"].to_numpy(), t["start"].to_numpy()
            _, groups = np.unique(t["anchor"].to_numpy(), return_inverse=True)
            text, inner = radix_repeats(groups, t["bytes"].to_pylist(), uids, starts, window)
            # Neighbouring windows become one row.
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (inner[1:] != inner[:-1] + 1)]) if len(text) else np.zeros(0, bool)
            head = np.flatnonzero(new)
            columns = [uids[text[head]], starts[text[head]] + inner[head], np.diff(head, append=len(text))]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["uid", "start", "n"])

        kept: list[pa.RecordBatch] = []
        for batch in by_bytes(batches, "bytes", 1 << 20):
            anchors = batch.column("anchor").to_numpy()
            last = int(np.searchsorted(anchors, anchors[-1]))  # where the last, perhaps unfinished group begins
            if kept and (last or kept[-1].column("anchor")[-1].as_py() != anchors[0]):
                if last:
                    kept.append(batch.slice(0, last))
                yield ordered(kept)
                kept = []
            elif last:
                yield ordered([batch.slice(0, last)])
            kept.append(batch.slice(last))
        if kept:
            yield ordered(kept)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return map_batches(dealt, run, "uid bigint, start bigint, n bigint")


def _group_windows(contexts: DataFrame, window: int) -> DataFrame:
    """The same for anchors with too many contexts for a task: windows are rows.

    Grouping by the window's bytes reduces before the shuffle; the join back
    splits large groups.
    """
    inner = F.explode(F.sequence(F.lit(0), F.length("bytes") - window))
    windows = contexts.select("uid", "start", "bytes", inner.alias("i")).select(
        "uid", (F.col("start") + F.col("i")).alias("start"), F.substring("bytes", F.col("i") + 1, F.lit(window)).alias("bytes")
    )
    first = windows.groupBy("bytes").agg(F.min(F.struct("uid", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    again = windows.join(first.filter("n > 1"), "bytes").filter(F.struct("uid", "start") != F.col("first"))
    return again.select("uid", "start", F.lit(1).cast("long").alias("n"))


def _with_uid(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``uid``: distinct, and in the order of (id, place read).

    Ids are that already unless one repeats; then rows are sorted into ranges
    once and numbered, in a stored copy.
    """
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID))
    repeated = docs.select(key.alias("uid")).groupBy("uid").count().filter("count > 1").limit(1).count()
    if not repeated:
        return docs.withColumn("uid", key)
    rows = docs.withColumn("uid", key).withColumn("row read", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("uid", "row read").sortWithinPartitions("uid", "row read").drop("row read", "uid")
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "numbered")


def repeated_ranges(docs: DataFrame, window: int, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """``uid, start, n``: starts of all windows that also start earlier, as ranges.

    ``docs`` has ``uid`` (distinct) and ``text``.
    """
    found = stored(_resolve_contexts(_runs(docs, window)), "runs")
    whole = found.filter("anchor IS NULL").select(
        "uid", F.shiftright("place", 8).alias("start"), F.col("place").bitwiseAND(F.lit(255)).alias("n")
    )
    firsts = found.filter("anchor IS NOT NULL")
    contexts = _context_bytes(firsts, _packed(docs.select("uid", "text"), "text"), window)
    hot = firsts.groupBy("anchor").count().filter(F.col("count") > group_contexts).select("anchor")
    if hot.limit(1).count():
        contexts = stored(contexts, "contexts")
        few, many = contexts.join(hot, "anchor", "left_anti"), contexts.join(hot, "anchor", "left_semi")
        ends = _order_windows(few, window).unionByName(_group_windows(many, window))
    else:
        ends = _order_windows(contexts, window)
    return stored(whole.unionByName(ends), "ranges")


def remove_repeats(
    docs: DataFrame, window: int = 100, doc_id: str = "doc_id", text: str = "text", whole_characters: bool = False,
    group_contexts: int = GROUP_CONTEXTS,
) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``spans`` and ``kept``.

    A byte is removed if a ``window``-byte string that covers it also starts
    earlier: in a smaller id (null ids last; rows of one id in the order read),
    or in the same row at a smaller start.  Texts are judged as they came in.
    ``spans`` lists the maximal removed runs (start, length), ``kept`` holds the
    other bytes (binary).  With ``whole_characters`` a UTF-8 character goes
    only if all its bytes do, so ``kept`` is text again.  Null texts count as
    empty; texts shorter than the window stay whole; of repeated rows the first
    keeps its text.  Columns named like the results are replaced, others pass;
    an empty table stays empty.  ``window`` is from 33 to 280 bytes.
    """
    if not ANCHOR < window <= ANCHOR + 248:
        raise ValueError("window must be from 33 to 280 bytes")
    outputs = ["n_bytes", "spans", "kept"]
    rows = _with_uid(without(docs, [*outputs, "uid"]).withColumn(text, text_or_empty(text)), doc_id, text)
    plain = rows.select("uid", F.col(f"`{text}`").alias("text"))
    ranges = repeated_ranges(plain, window, group_contexts)
    per_row = ranges.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    others = rows.drop(text)
    joined = _packed(rows, text).join(per_row, "uid", "left")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = replaced_schema(
        others,
        ["uid"],
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(span)),
        T.StructField("kept", T.BinaryType()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in by_bytes(batches, "packed text", 2 << 20):
            sizes, spans, kept = [], [], []
            for packed, found in zip(batch.column("packed text").to_pylist(), batch.column("ranges").to_pylist()):
                whole = unpack(packed)
                edges = np.zeros(len(whole) + 1, np.int32)
                if found:
                    starts = np.array([r["start"] for r in found])
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + np.array([r["n"] for r in found]) + (window - 1), -1)
                gone = np.cumsum(edges[:-1]) > 0
                raw = np.frombuffer(whole, np.uint8)
                if whole_characters and len(raw):
                    head = np.flatnonzero((raw & 0xC0) != 0x80)
                    gone = np.repeat(np.logical_and.reduceat(gone, head), np.diff(head, append=len(raw)))
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                sizes.append(len(whole))
                spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(turns[::2], turns[1::2])])
                kept.append(raw[~gone].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            more = {"n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())}
            yield with_columns(batch, ["uid", "packed text", "ranges"], more)

    return map_batches(joined, run, schema)
