"""Conversation repair, personal data and the Merkle manifest against brute force."""

import hashlib
import heapq
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lendlake.llm import conversation_repair as cr
from lendlake.llm import merkle, pii, queries
from tests.llm.util import prose

WS = " \t\n\x0b\x0c\r"
CONV = "conv_id bigint, turn bigint, role string, text string"


# Conversation repair


def shown(v):
    return " " if v is None else str(v)


def plain_damage(table):
    for c, t, r, x in table:
        kind = zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20
        r, x = shown(r), shown(x)
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            yield from [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)


def plain_faults(rows):
    seen, out = set(), []
    for _, r, x in rows:
        body = x.rstrip(WS)
        out.append("b" if not body else "d" if (r, x) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def plain_repair(rows, faults):
    """Shortest path by (cost, audit) over (row, last initial)."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        to = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[to]
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*out, (name, ""))))
        if i < len(rows):
            (_, r, x), more = rows[i], 5 * (faults[i] == "t")
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if faults[i] not in ("b", "d"):
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*out, (name, x))))
                if r[:1] == to or (last == "" and r[:1] == "s"):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, r[:1], (*out, (r, x))))


def plain_op11(table):
    convs = {c: [] for c, *_ in table}
    for c, t, r, x in plain_damage(table):
        convs[c].append((t, r, x))
    for c, rows in convs.items():
        rows.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        faults = plain_faults(rows)
        first = [r[:1] for _, r, _ in rows]
        cost, audit, out = plain_repair(rows, faults)
        yield (
            c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
        )


def conversations(seed, n, turns):
    r = random.Random(seed)
    texts = ["Fine.", "What?", "no end", "", " \t", "Fine. ", "日本。", "x!" * 50, None]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "agent"]
    for c in range(n):
        for t in range(r.randrange(turns)):
            turn = r.choice([t, t, t, t + 3, None])
            yield (c or None, turn, r.choice(roles[:3] * 4 + roles), r.choice(texts[:3] * 4 + texts))


def key(row):
    return tuple((x is not None, x) for x in row)


def run_op11(spark, tmp_path, rows, name):
    data = spark.createDataFrame(rows, CONV).withColumn("place", F.lit("clash")).withColumn("audit", F.lit(1)).withColumn("kind", F.lit(9))
    data.repartition(3).write.parquet(str(tmp_path / name / "conversations.parquet"))
    return queries.op11_conversation_repair(spark, str(tmp_path / name))


def test_repair_of_odd_conversations(spark, tmp_path, monkeypatch):
    rows = list(conversations(1, 60, 12)) + [(900, None, "user", "Only."), (900, None, "assistant", "Nulls.")]
    rows += [(901, 1, "user", "Same."), (901, 1, "user", "Same.")]
    rows += [(903, i, ("user", "assistant")[i % 2], "w " * 40_000 + ".") for i in range(4)]
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone"))
    for bits in (cr.SEGMENT_BITS, 1):  # also with conversations of many segments
        monkeypatch.setattr(cr, "SEGMENT_BITS", bits)
        got = [tuple(r) for r in run_op11(spark, tmp_path, rows, f"odd{bits}").collect()]
        assert sorted(got, key=key) == sorted(plain_op11(rows), key=key)
    empty = hashlib.sha256(b"").hexdigest()
    assert (dropped, 0, 0, 0, 0, 0, 0, "", empty) in got
    assert run_op11(spark, tmp_path, [], "none").collect() == []


def test_repaired_rows_follow_the_grammar(spark):
    rows = list(conversations(5, 40, 9))
    found = cr.repair(cr.damage(spark.createDataFrame(rows, CONV)))
    out = {}
    for r in sorted(found.repaired().collect(), key=lambda r: (r["conv"], r["place"])):
        out.setdefault(r["conv"], []).append((r["role"], r["text"]))
    plain = {}
    for c, t, r, x in plain_damage(rows):
        plain.setdefault(shown(c), []).append((t, r, x))
    for conv, turns in plain.items():
        turns.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))
        assert tuple(out.get(conv, ())) == plain_repair(turns, plain_faults(turns))[2]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out.get(conv, ())))


@given(st.lists(st.text("ABCDEFGHIJKLMNOP", min_size=1, max_size=14), min_size=1, max_size=4), st.randoms())
@settings(max_examples=150, deadline=None)
def test_any_grammar_gives_the_cheapest_repair(seqs, r):
    symbols, rules = list("ABCDEFGHIJKLMNOP"), []
    for i in range(6):
        pair = r.choice(symbols) + r.choice(symbols)
        rules.append((chr(cr.FIRST_RULE + i), pair))
        symbols.append(rules[-1][0])
    got = cr.Evaluator(rules, cr.grammar(rules)).run(iter(seqs))
    rows, faults = [], []
    for i, letter in enumerate("".join(seqs)):
        role, fault = cr.parts(letter)
        rows.append((i, ["system", "user", "assistant", "tool"][role], str(i)))
        faults.append(["", "b", "d", "t"][fault])
    first = ["suax"[cr.parts(x)[0]] for x in "".join(seqs)]
    bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    cost, audit, _ = plain_repair(rows, faults)
    assert got == (*map(faults.count, "bdt"), bad, cost, audit)


def test_rules_are_learned_and_shared(spark):
    kinds = spark.createDataFrame([("FGFGFG", 10), ("EFGFG", 3), ("P", 1), ("FF", 1)], "seq string, n bigint")
    rules = cr.learn(kinds)
    assert rules[0][1] == "FG" and len({new for new, _ in rules}) == len(rules)
    assert cr.learn(kinds.limit(0)) == []


# Personal data

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == 0
                or kind == 1 and all(int(p) <= 255 for p in m.group().split("."))
                or kind == 2 and 14 <= len(digits) <= 19 and plain_luhn(digits)
                or kind == 3 and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@given(st.text("0159.@+-( )a_é\n", max_size=60))
@settings(max_examples=600, deadline=None)
def test_rules_equal_the_patterns(text):
    assert pii.base_spans(text)[0] == plain_spans(text)


@given(st.lists(st.sampled_from(["4041894974608795", "4041 8949 7460 8795", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "a@b.c", "@", "+1 (988) 555-2485",
                                 " ", "-", ".", "x", "4", "日"]), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_rules_equal_the_patterns_on_near_hits(text):
    assert pii.base_spans(text)[0] == plain_spans(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1.2." * 400_000, "a@" * 800_000, "+1 " * 300_000, "12 " * 500_000):
        start = time.time()
        pii.base_spans(text)
        assert sum(1 for _ in pii.candidates(text)) <= len(text)
        assert time.time() - start < 20


def planted(seed, n):
    r = random.Random(seed)
    for i in range(n):
        card = "4" + "".join(r.choice("0123456789") for _ in range(14))
        card += next(d for d in "0123456789" if plain_luhn(card + d))
        found = [
            f"{r.choice(['ann', 'bob'])}.{r.randrange(99)}@mail{i % 9}.example.com",
            ".".join(str(r.randrange(256)) for _ in range(4)),
            card,
            f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}",
        ]
        wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
        yield (i, f"{prose(i, 12)}{r.choice([' ', ' 42, '])}{found[i % 4]} {wrong if i % 3 else ''} {prose(i + n, 9)} token {r.getrandbits(64)} {r.randrange(10**6)}")


def test_trees_add_what_the_rules_pass_over(spark):
    docs = spark.createDataFrame(list(planted(3, 800)), "doc_id bigint, text string")
    model = pii.learn(docs)
    assert all(t < 1 for t in model.thresholds)
    odd = [
        (1, "see +1 (269) 555-3296 4041894974608795 there"), (2, None), (3, ""), (4, prose(8, 300)), (4, prose(8, 300)), (None, "a@b.cd"),
        (5, "bob.17(at)mail8.example.com wrote"), (6, "x" * 100_000), (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"),
    ]
    rows = spark.createDataFrame(odd, "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("kind", F.lit("old"))
    out = pii.redact(rows, model)
    assert sorted(out.columns) == ["doc_id", "kind", "redacted", "spans", "text"]
    got = {}
    for r in out.collect():
        base = [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["base"]]
        assert base == plain_spans(r["text"] or "")
        got.setdefault(r["doc_id"], []).append((r["redacted"], len(r["spans"])))
    assert got[1] == [("see [PHONE] [CARD] there", 2)]
    assert got[2] == got[3] == [("", 0)] and got[4] == [(prose(8, 300), 0)] * 2 and got[None] == [("[EMAIL]", 1)]
    assert got[5][0][0] == "[EMAIL] wrote" and got[6][0][1] == 0 and got[7][0][1] == 0
    assert pii.redact(rows.limit(0), pii.learn(docs.limit(0))).collect() == []


def test_every_candidate_is_learned_from(spark, monkeypatch):
    docs = spark.createDataFrame(list(planted(5, 400)) + [(i, None) for i in range(9)], "doc_id bigint, text string")
    tables = []
    monkeypatch.setattr(pii, "stored", lambda df, label: tables.append(df.collect()) or spark.createDataFrame(tables[-1], df.schema))
    model = pii.learn(docs)
    every = [y for r in planted(5, 400) for _, y, _ in pii.examples(r[1])]
    assert sum(r["n"] for r in tables[0]) == len(every)
    assert sum(r["n"] for r in tables[0] if r["label"]) == sum(every)
    assert model.trees and all(t < 1 for t in model.thresholds)


def test_threshold_counts_equal_scores_together():
    scored = [(0.2, 0), (0.6, 0), (0.6, 1), (0.7, 1), (0.9, 1), (0.9, 1)]
    counted = [(0.9, 2, 2), (0.2, 0, 1), (0.6, 1, 2), (0.7, 1, 1)]
    for p in (0.4, 0.5, 0.99):
        assert pii.threshold(scored, p) == pii.threshold_of(counted, p)


def test_trees_equal_the_fitted_classifier(spark):
    rows = [(x, y) for _, t in planted(4, 300) for _, y, x in pii.examples(t)]
    data = spark.createDataFrame([(x, float(y)) for x, y in rows], "x array<double>, label double").select(array_to_vector("x").alias("features"), "x", "label")
    fitted = GBTClassifier(maxIter=5, maxDepth=4, seed=1).fit(data)
    model = pii.Model(pii.trees_of(fitted))
    for r in fitted.transform(data).select("x", vector_to_array("probability")[1].alias("p")).collect():
        assert model.score(r["x"]) == pytest.approx(r["p"], abs=1e-9)


def test_threshold_is_isotonic():
    assert pii.threshold([(0.2, 0), (0.6, 0), (0.7, 1), (0.9, 1)], 0.99) == 0.7
    assert pii.threshold([(0.7, 1), (0.9, 0)], 0.99) == 2.0 == pii.threshold([], 0.99)


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def plain_proof(levels, i):
    for level in levels[:-1]:
        s = i // 16 * 16
        yield level[s:i], level[i + 1 : s + 16]
        i //= 16


def plain_op13(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], leaf_of(r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    levels = {s: plain_levels([x[1] for x in by[s]]) for s in sources}
    top = plain_levels([levels[s][-1][0] for s in sources])
    root = top[-1][0]
    for k, s in enumerate(sources):
        for i, (d, leaf, r) in enumerate(by[s]):
            proof = [*plain_proof(levels[s], i), *plain_proof(top, k)]
            x = leaf
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and r[4] is not None:
                x = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for a, b in proof:
                x = H(*a, x, *b)
            yield d, leaf, levels[s][-1][0], root, H(*[y for a, b in proof for y in (*a, *b)]), x, x == root


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def manifest_rows(seed, hot, sources):
    r = random.Random(seed)
    for i in range(hot):
        yield (i, "hot", r.choice(["en", None]), i, f"Text {i}")
    for s in range(sources):
        for i in range(r.choice([1, 2, 16, 17])):
            yield (r.choice([None, i, 5 * i]), f"s{s}é", "de", None, r.choice([None, "", "ÄB", "x" * 200_000]))
    yield from [(7, None, None, None, None)] * 3 + [(8, "", "", 0, "")] * 2


@pytest.mark.parametrize("hot,sources", [(700, 5), (3, 40), (0, 0)])
def test_manifest_of_odd_rows(spark, tmp_path, hot, sources):
    rows = list(manifest_rows(hot, hot, sources))
    data = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("old").alias(c) for c in ("tree", "at", "size", "node", "up", "path", "place", "leaf")])
    data.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op13_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(plain_op13(rows), key=key)


def test_manifest_stride_and_stored_levels(spark):
    rows = list(manifest_rows(1, 300, 2))
    docs = spark.createDataFrame(rows, DOCS)
    expected = sorted(r[1:5] for r in plain_op13(rows))
    for stride in (1, 3):
        made = merkle.build(docs, stride=stride)
        got = merkle.prove(made).select("leaf", "subroot", F.lit(made.root), merkle.sha(merkle.proof_text(F.col("path"))))
        assert sorted(map(tuple, got.collect())) == expected
    made = merkle.build(docs)
    assert len(made.forest.levels) == 3  # 300 leaves: levels 0, 2 and 4; level 1 and 3 are regenerated
    assert made.forest.levels[1].filter("tree = '3:hot'").count() == 2


def test_manifest_of_single_rows(spark):
    rows = [(i, f"s{i}", None, None, None) for i in range(20)]
    got = merkle.prove(merkle.build(spark.createDataFrame(rows, DOCS))).select("doc_id", "leaf", "subroot", merkle.sha(merkle.proof_text(F.col("path"))))
    assert sorted(map(tuple, got.collect())) == sorted((r[0], r[1], r[2], r[4]) for r in plain_op13(rows))


def test_manifest_of_an_empty_table(spark):
    made = merkle.build(spark.createDataFrame([], DOCS))
    assert made.root is None and merkle.prove(made).collect() == []
