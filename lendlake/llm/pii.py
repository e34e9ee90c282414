"""Personal data: fixed rules, and candidates scored by boosted trees.

Four kinds are found by fixed rules (``base_spans``).  What those rules pass
over, because a longer match failed its check or because the form is another
(no country code, ``(at)`` for ``@``, ``[.]`` for a dot), is left to
candidates: generators with high recall propose overlapping spans, gradient
boosted trees score them by features of their format and context, and one
calibrated threshold for each kind selects.  Spans of the rules always stay.

The trees learn from the rules by distant supervision, on every candidate of
every document; equal feature vectors count together.  A candidate equal to a span of the rules is positive, and so are
rewritten forms of it in its place; fragments, matches that failed their check
and other candidates are negative; what touches a failed match without being
it is not used.
Spark ML fits the trees; the tasks that scan the texts evaluate them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import ceil, exp, sqrt
from zlib import crc32

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, with_columns
from lendlake.llm.common import stored, text_or_empty

# Fixed values of the rules, in the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
CARD_DIGITS = range(14, 20)
PHONE_DIGITS = range(10, 16)
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, so other places need no try.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end (code points, end exclusive)

TREES, DEPTH = 10, 4
PRECISION = 0.99  # of what a threshold lets through, estimated on held-out candidates
MAX_BINS = 1024  # cut points a feature; Spark takes them from all vectors up to the square of their number
SCORE_CELLS = 10_000  # a kind's held-out scores are counted in so many cells
CONTEXT = 40


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in re.findall("[0-9]+", s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern would match from the left, in linear time: from each ``@`` outwards."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the rules, and matches that failed their check; both by start, then kind."""
    good = [(a, EMAIL, b) for a, b in _emails(text)]
    bad: list[Span] = []
    for m in _IP.finditer(text):
        (good if octets(m.group()) else bad).append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = digits_of(m.group())
            (good if len(digits) in CARD_DIGITS and luhn(digits) else bad).append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            (good if len(digits_of(m.group())) in PHONE_DIGITS else bad).append((m.start(), PHONE, m.end()))
    return sorted(good), sorted(bad)


# Candidates

_CHAIN = re.compile(r"[0-9](?:[\x20().-]{0,3}[0-9]){9,}")
_RUN = re.compile("[0-9]+")
_DOT = r"(?:\.|\x20?[\[(](?:\.|dot)[\])]\x20?)"
_LOOSE_IP = re.compile(rf"(?<![0-9])(?=([0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}})(?![0-9]))")
_AT = re.compile(r"@|\x20?[\[(]at[\])]\x20?|\x20at\x20(?=[\w-]+(?:\x20dot\x20[\w-]+)+)")
_LOOSE_DOMAIN = re.compile(rf"[\w-]+(?:(?:{_DOT}|\x20dot\x20)[\w-]+)+")
_LOOSE_LOCAL = re.compile(r"[\w.%+'-]{1,64}\Z")
MOST_RUNS = 6  # runs of digits that one number is written in


def candidates(text: str) -> Iterator[Span]:
    """Overlapping spans that might be of a kind; a number has at most ``MOST_RUNS`` runs of digits."""
    for m in _AT.finditer(text):
        local = _LOOSE_LOCAL.search(text[max(0, m.start() - 64) : m.start()])
        domain = _LOOSE_DOMAIN.match(text, m.end())
        if local and domain:
            yield m.start() - len(local.group()), EMAIL, domain.end()
    for m in _LOOSE_IP.finditer(text):
        yield m.start(), IP, m.end(1)
    for chain in _CHAIN.finditer(text):
        runs = [r.span() for r in _RUN.finditer(text, chain.start(), chain.end())]
        for i, (start, _) in enumerate(runs):
            left = start - (start > 0 and text[start - 1] in "+(")
            left -= left > 0 and text[left] == "(" and text[left - 1] == "+"
            if left and text[left - 1].isalnum():
                continue  # a part of a longer code
            total = 0
            for a, end in runs[i : i + MOST_RUNS]:
                total += end - a
                if total > CARD_DIGITS[-1]:
                    break
                if text[end : end + 1].isalnum():
                    continue
                if total in PHONE_DIGITS:
                    yield left, PHONE, end
                if total in CARD_DIGITS:
                    yield start, CARD, end


_CUES = [re.compile(p, re.I) for p in (r"mail|contact", r"\bip\b|host|server|addr", r"card|visa|credit|karte", r"phone|call|tel|mobil|fax")]
_NOT_PERSONAL = re.compile(r"key|token|secret|passw|hash|sha|isbn|version|\bid\b|=", re.I)


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 4 if c in "+@=" else 3


def features(text: str, span: Span) -> list[float]:
    """Format of the span, and context up to ``CONTEXT`` code points beside it."""
    start, kind, end = span
    s = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    runs = [len(r) for r in _RUN.findall(s)] or [0]
    digits = digits_of(s)
    gap_left = before[::-1][:3]
    gap_right = after[:3]
    labels = re.split(r"\W+", s[re.search(r"@|\bat\b", s).end() :]) if kind == EMAIL else [""]
    values = [
        *[float(kind == k) for k in range(4)],
        len(s), len(digits), sum(map(str.isalpha, s)), len(runs), max(runs), min(runs), runs[0], runs[-1],
        float(s[0] == "+"), s.count("("), s.count(" "), s.count("."), s.count("-"),
        float(bool(digits) and luhn(digits)), float(kind == IP and octets(s)),
        float("@" in s), len(labels), len(labels[-1]), float(labels[-1].isalpha()),
        _side(before[-1:]), _side(after[:1]),
        float(any(c.isdigit() for c in gap_left)), float(any(c.isdigit() for c in gap_right)),
        float("+" in gap_left), float(gap_left[:1] == "."), float(gap_right[:1] == "." and gap_right[1:2].isdigit()),
        *[float(bool(cue.search(before))) for cue in _CUES],
        float(bool(_NOT_PERSONAL.search(before[-16:]))),
    ]
    return [float(v) for v in values]


def rewritten(text: str, span: Span) -> Iterator[tuple[str, Span, int]]:
    """Other forms of a span of the rules in its context, and their labels: numbers grouped like dates are none."""
    start, kind, end = span
    s = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    forms = []
    if kind == EMAIL:
        local, _, domain = s.partition("@")
        forms = [f"{local}(at){domain}", f"{local} [at] {domain.replace('.', ' [dot] ')}", f"{local} at {domain.replace('.', ' dot ')}"]
    elif kind == IP:
        forms = [s.replace(".", "[.]")]
    elif kind == PHONE and (m := re.match(r"\+[0-9]{1,3}[\x20.-]+", s)) and len(digits_of(s[m.end() :])) in PHONE_DIGITS:
        forms = [s[m.end() :]]
    for form in forms:
        yield before + form + after, (len(before), kind, len(before) + len(form)), 1
    if kind in (CARD, PHONE):
        d = digits_of(s)
        form = f"{d[:4]}-{d[4:6]}-{d[6:8]} " + " ".join(d[i : i + 2] for i in range(8, len(d), 2))
        yield before + form + after, (len(before), kind, len(before) + len(form)), 0


def disjoint(spans: list[Span]) -> list[tuple[int, int]]:
    """What the spans cover, by start."""
    out: list[tuple[int, int]] = []
    for a, _, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def free(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether nothing of the disjoint ``taken`` lies between a and b."""
    i = bisect_left(taken, (a, b))
    return (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0])


def examples(text: str) -> Iterator[tuple[Span, int, list[float]]]:
    """Candidates of one text with their labels, as the module's docstring says."""
    good, bad = base_spans(text)
    known, wrong, failed = set(good), set(bad), disjoint(bad)
    for span in candidates(text):
        if span in known:
            yield span, 1, features(text, span)
            for other, form, label in rewritten(text, span):
                yield span, label, features(other, form)
        elif span in wrong or free(failed, span[0], span[2]):
            yield span, 0, features(text, span)


# The model

Tree = float | tuple  # a value, or (feature, limit, tree up to it, tree beyond)
_TEST = re.compile(r"\s*If \(feature (\d+) <= (\S+)\)")
_VALUE = re.compile(r"\s*Predict: (\S+)")


def read_tree(lines: Iterator[str]) -> Tree:
    """A tree from Spark's description of it."""
    line = next(lines)
    if m := _VALUE.match(line):
        return float(m[1])
    m = _TEST.match(line)
    low = read_tree(lines)
    next(lines)  # Else
    return int(m[1]), float(m[2]), low, read_tree(lines)


def value_of(tree: Tree, x: list[float]) -> float:
    while isinstance(tree, tuple):
        i, limit, low, high = tree
        tree = low if x[i] <= limit else high
    return tree


@dataclass
class Model:
    """Boosted trees with their weights, and a threshold for each kind; without trees nothing is added."""

    trees: list[tuple[float, Tree]] = field(default_factory=list)
    thresholds: tuple[float, ...] = (2.0,) * 4

    def score(self, x: list[float]) -> float:
        """Probability as Spark's classifier gives it."""
        return 1 / (1 + exp(-2 * sum(w * value_of(tree, x) for w, tree in self.trees)))


def trees_of(fitted: GBTClassificationModel) -> list[tuple[float, Tree]]:
    return [(float(w), read_tree(iter(t.toDebugString.strip().split("\n")[1:]))) for w, t in zip(fitted.treeWeights, fitted.trees)]


def threshold(scored: Iterable[tuple[float, int]], precision: float) -> float:
    """``threshold_of`` single candidates with their labels."""
    by_score: dict[float, list[int]] = {}
    for s, y in scored:
        by_score.setdefault(s, []).append(y)
    return threshold_of([(s, sum(ys), len(ys)) for s, ys in by_score.items()], precision)


def threshold_of(counted: Iterable[tuple[float, int, int]], precision: float) -> float:
    """The least score from which the isotonic estimate of precision is at least ``precision``; 2 if there is none.

    ``counted``: different scores with their positives and candidates.
    """
    blocks: list[list[float]] = []  # least score, positives, candidates
    for s, positives, candidates in sorted(counted):
        blocks.append([s, positives, candidates])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, y, n = blocks.pop()
            blocks[-1][1] += y
            blocks[-1][2] += n
    return next((max(0.5, s) for s, y, n in blocks if y >= precision * n), 2.0)


def learn(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """Fit the trees on all candidates of all texts of ``docs``.

    Features are counts and marks, so candidates are reduced to their different
    feature vectors, each with its number of candidates as its weight, before
    they move.  A fifth of the candidates, by their place and context, is held out
    to calibrate the thresholds; their scores are counted in ``SCORE_CELLS`` cells
    a kind, and only those counts go to the driver.  A kind without positive
    candidates gets no threshold that could be reached; with candidates of one
    label only, or an empty table, the model adds nothing.
    """
    source = docs.select(text_or_empty(text).alias("text"))
    schema = pa.schema([("held_out", pa.bool_()), ("kind", pa.int32()), ("label", pa.int32()), ("features", pa.list_(pa.float64())), ("n", pa.int64())])

    def held_out(t: str, span: Span) -> bool:
        a, kind, b = span
        return crc32(f"{kind}:{a}:{t[max(0, a - CONTEXT) : b + CONTEXT]}".encode()) % 5 == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            found = Counter((held_out(t, span), span[1], y, tuple(x)) for t in batch.column("text").to_pylist() for span, y, x in examples(t))
            columns = zip(*[(*key, n) for key, n in found.items()]) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(columns, schema)], schema=schema)

    every = map_batches(source, run, "held_out boolean, kind int, label int, features array<double>, n bigint")
    keys = ["held_out", "kind", "label", "features"]
    # In order, so that the same rows give the same trees.
    rows = stored(every.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(*keys), "pii-candidates")
    fit = rows.filter(~F.col("held_out"))
    sizes = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model()
    train = fit.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), F.col("n").cast("double").alias("n"))
    bins = min(MAX_BINS, max(32, ceil(sqrt(sum(sizes.values())))))
    booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, weightCol="n", maxBins=bins)
    model = Model(trees_of(booster.fit(train)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tested = pa.schema([("kind", pa.int32()), ("score", pa.float64()), ("positives", pa.int64()), ("n", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = pa.array([model.score(x) for x in batch.column("features").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("kind"), scores, batch.column("positives"), batch.column("n")], schema=tested)

    asked = rows.filter("held_out").select("kind", "features", (F.col("n") * F.col("label")).alias("positives"), "n")
    scored = map_batches(asked, score, "kind int, score double, positives bigint, n bigint")
    cells = scored.groupBy("kind", F.floor(F.col("score") * SCORE_CELLS).alias("cell"))
    counted: list[list[tuple[float, int, int]]] = [[] for _ in KINDS]
    for r in cells.agg(F.min("score").alias("score"), F.sum("positives").alias("y"), F.sum("n").alias("n")).collect():
        counted[r["kind"]].append((r["score"], r["y"], r["n"]))
    model.thresholds = tuple(threshold_of(c, precision) for c in counted)
    return model


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Candidates over their threshold that overlap no span of the rules; of overlapping ones the best."""
    if not model.trees:
        return []
    known = set(base)
    scored = []
    for span in candidates(text):
        if span not in known and (s := model.score(features(text, span))) >= model.thresholds[span[1]]:
            scored.append((-s, span[0] - span[2], span))
    taken, out = disjoint(base), []
    for _, _, (a, kind, b) in sorted(scored):
        if free(taken, a, b):
            insort(taken, (a, b))
            out.append((a, kind, b))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    out, end = [], 0
    for a, kind, b in spans:
        if a >= end:
            out += [text[end:a], f"[{KINDS[kind].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def redact(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``spans`` (by start, then kind; ``base`` marks those of the rules) and ``redacted``.

    Whole texts, row by row, no shuffle: null counts as empty, repeated rows get
    equal spans, other columns pass unchanged, columns named like the two are
    replaced, an empty table stays empty.  The time is linear in the text:
    a place has a bounded number of candidates.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    drop = ["spans", "redacted"] + ([] if keep_text else [text])
    schema = replaced_schema(docs, drop, T.StructField("spans", SPANS), T.StructField("redacted", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in by_bytes(batches, text, 2 << 20):
            spans, clean = [], []
            for t in batch.column(text).to_pylist():
                t = t or ""
                base, _ = base_spans(t)
                found = sorted([(*s, True) for s in base] + [(*s, False) for s in added_spans(t, base, model)])
                spans.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in found])
                clean.append(redacted(t, [s[:3] for s in found]))
            yield with_columns(batch, drop, {"spans": pa.array(spans, _SPANS), "redacted": pa.array(clean, pa.string())})

    return map_batches(docs, run, schema)
