"""The pipeline against plain Python, stage by stage."""

from collections import Counter, defaultdict
from hashlib import md5
from math import log

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendlake.llm.common import keep_rows
from tests.llm.test_groups import bare, plain_components, plain_fingerprint, plain_removed
from tests.llm.test_tokens import check_packing, words  # noqa: F401
from tests.llm.util import CLASH, ODD, empty_docs, odd_docs

SMOKE = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
OTHERS = [*CLASH, "uid", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "trusted mark", "row key", "row hash", "a.b"]


def clashing_docs(spark):
    docs = odd_docs(spark, clash=False)
    return docs.select("*", *[F.concat(F.lit(f"old {c} "), F.xxhash64("doc_id", "text")).alias(c) for c in OTHERS])


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stage_passes_clashing_columns(spark, name):
    docs = clashing_docs(spark)
    plain = STAGES[name](spark, odd_docs(spark, clash=False), SMOKE)
    out = STAGES[name](spark, docs, SMOKE)
    assert out.columns == docs.columns and plain.columns == ["doc_id", "text", "n_chars"]
    rows = [tuple(r) for r in out.collect()]
    assert sorted(map(str, (r[:3] for r in rows))) == sorted(str(tuple(r)) for r in plain.collect())
    assert rows and {r[3:] for r in rows} <= {tuple(r)[3:] for r in docs.collect()}


def test_packing_ignores_clashing_columns(spark):
    a = STAGES["best-fit packing"](spark, clashing_docs(spark), SMOKE)
    b = STAGES["best-fit packing"](spark, odd_docs(spark, clash=False), SMOKE)
    assert a.columns == b.columns and a.count() == b.count() > 0


# Plain versions: lists of (doc_id, text) in id order, null ids last.

def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def plain_grams(text):
    h = [int.from_bytes(md5(w).digest()[:4], "big") for w in (text or "").encode().split()]
    return Counter([x % 65536 for x in h] + [(a * 1000003 + b) % 65536 for a, b in zip(h, h[1:])])


def plain_quality(rows, good):
    grams = [plain_grams(t) for _, t in rows]
    raw, target = sum(grams, Counter()), sum((g for (i, _), g in zip(rows, grams) if i in good), Counter())
    out = []
    for (i, t), g in zip(rows, grams):
        tokens = (t or "").encode().split()
        windows = [tuple(tokens[k : k + 5]) for k in range(len(tokens) - 4)]
        again = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        own = g if i in good else Counter()
        size, score = target.total() - own.total(), 0
        for b, n in g.items():
            score += n * round(1e6 * (log(target[b] - own[b] + 8) - log(size * raw[b] / raw.total() + 8)))
        if len(tokens) >= 10 and 100 * len(again) <= 20 * len(tokens) and score >= -150_000 * g.total():
            out.append((i, t))
    return out


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i, t))
    return in_order([min(g, key=lambda r: r[:3])[3:] for g in groups.values()])


def plain_near(rows):
    # Ids by place: null ids have one too, and the first place of a component is its smallest id.
    marks = [(n, plain_fingerprint(t)) for n, (_, t) in enumerate(rows)]
    return [rows[n] for n in sorted(set(plain_components(marks, 4)))]


def plain_passages(rows):
    out = []
    for (i, t), (b, gone) in zip(rows, plain_removed([t for _, t in rows], 100)):
        kept, at = "", 0
        for c in t:
            end = at + len(c.encode())
            kept += "" if gone[at:end].all() else c
            at = end
        out.append((i, kept))
    return out


PLAIN = [plain_exact, plain_near, plain_passages]


def check_stages(spark, docs, sf_dir, good, words):
    """Every stage on what its predecessor kept, against the plain version on the same rows."""
    want, sizes = [(r["doc_id"], r["text"]) for r in docs.collect()], []
    others = docs.columns[3:]
    for (name, stage), plain in zip(corpus_pipeline.STAGES, [lambda rows: plain_quality(rows, good), *PLAIN]):
        docs = stage(spark, docs, sf_dir).localCheckpoint()
        want = plain(in_order(want))
        got = docs.collect()
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(want), name
        assert docs.columns == ["doc_id", "text", "n_chars", *others]
        assert all(r["n_chars"] == len(r["text"]) for r in got), name
        sizes.append((len(got), sum(r["n_chars"] for r in got)))
    return want, sizes


def check_packed(rows, want, words):
    tokens = {i: words(t) + [0] for i, t in want}
    assert {r["doc_id"] for r in rows} == set(tokens)
    return check_packing(rows, tokens, 2048)


def test_stages_and_run_on_smoke(spark, words):  # noqa: F811
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet").filter("quality = 1").collect()
    want, sizes = check_stages(spark, docs, SMOKE, {r["doc_id"] for r in labels}, words)
    assert docs.count() > sizes[0][0] > sizes[1][0] >= sizes[2][0] == sizes[3][0]
    check_packed(corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(want, "doc_id bigint, text string"), SMOKE).collect(), want, words)
    check_packed(corpus_pipeline.run(spark, SMOKE).collect(), want, words)


def odd_folder(spark, folder, docs, good):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("good", [[4, 6], [777, None], [10, 12, 12]])
def test_stages_and_run_on_odd_rows(spark, tmp_path, words, good):  # noqa: F811
    docs = clashing_docs(spark).drop("a.b", *[c for c in OTHERS if " " in c])
    folder = odd_folder(spark, tmp_path, docs, good)
    want, _ = check_stages(spark, docs, folder, set(good) - {None}, words)
    check_packed(corpus_pipeline.run(spark, folder).collect(), want, words)


def test_run_on_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, odd_folder(spark, tmp_path, empty_docs(spark), [1])).collect() == []


def test_passages_cut_whole_characters(spark):
    texts = ["é" * 99 + "x" + "ü" * 60, "ß" + "é" * 99 + "x" + "ü" * 60, "é" * 99 + "x" + "ü" * 9 + " end"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id bigint, text string, n_chars bigint")
    got = STAGES["suffix-array dedup"](spark, docs, SMOKE).collect()
    want = plain_passages(rows)
    assert sorted((r["doc_id"], r["text"]) for r in got) == want and want[2][1] != texts[2]
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_keep_rows_by_id_and_text(spark):
    docs = odd_docs(spark)
    for i, t in ODD:
        named = spark.createDataFrame([(i, t), (i, t)], "doc_id bigint, text string")
        named = named.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"))
        out = keep_rows(docs, named)
        assert out.columns == docs.columns and [(r["doc_id"], r["text"]) for r in out.collect()] == [(i, t)]
