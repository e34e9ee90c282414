"""Deduplication, sharding, rules, scores and chat against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendlake.llm import chat, classifier, exact_dedup, quality_rules, queries, sharding, simhash, suffix_dedup
from tests.llm.util import ODD, PASSAGE, empty_docs, odd_docs, prose
from tests.twin import compare, duck

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twins(spark, name):
    problems, _ = compare(spark, duck(SMOKE), name, queries.QUERIES[name], queries.ORACLES[name], SMOKE)
    assert not problems, problems


# Exact deduplication

def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_odd_rows_and_second_batch(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    rows = exact_dedup.dedup_exact(odd_docs(spark), index).collect()
    groups = defaultdict(list)
    for i, t in ODD:
        groups[hashlib.sha256(bare(t).encode()).hexdigest()].append((-len(t or ""), i is None, i or 0, i))
    assert len(rows) == len(ODD)
    for r in rows:
        g = groups[r["text_sha256"]]
        assert r["group_size"] == len(g) and r["keep_id"] == min(g)[3]
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter(groups.keys())
    # Known texts come back dropped, new ones kept; the index gains the new ones only.
    more = spark.createDataFrame([(50, ODD[3][1]), (51, "quite new")], "doc_id bigint, text string")
    second = {r["doc_id"]: r for r in exact_dedup.dedup_exact(more, index).collect()}
    assert not second[50]["kept"] and second[50]["keep_id"] == 13 and second[51]["kept"]
    assert index.table().count() == len(groups) + 1
    assert exact_dedup.dedup_exact(empty_docs(spark), index).collect() == []


def test_exact_index_is_not_shuffled(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.dedup_exact(odd_docs(spark), index).count()
    groups = spark.range(9).select(exact_dedup.digest(F.col("id").cast("string")).alias("digest"))
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


# Sharding

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=8), st.integers(1, 6), st.integers(0, 10))
def test_matrix_margins(counts, shards, seed):
    total = sum(counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = sharding.communication_matrix(counts, sizes, seed)
    assert [sum(r) for r in matrix] == counts and [sum(c) for c in zip(*matrix)] == sizes


def test_hypergeometric_law():
    draws = Counter(sharding.draw_hypergeometric(np.random.default_rng(s), 5, 7, 6) for s in range(6000))
    from math import comb

    for k in range(6):
        p = comb(5, k) * comb(7, 6 - k) / comb(12, 6)
        assert abs(draws[k] / 6000 - p) < 5 * (p * (1 - p) / 6000) ** 0.5 + 1e-3
    assert 49e8 < sharding.draw_hypergeometric(np.random.default_rng(1), 10**10, 10**10, 10**10) < 51e8


def test_shards_odd_rows(spark):
    rows = sharding.shuffle_into_shards(odd_docs(spark), 5, rows_per_task=2).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, ODD))
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[s]) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shuffle_into_shards(empty_docs(spark), 5).collect() == []


def test_shards_are_uniform(spark):
    rows = spark.range(0, 6000, 1, 6)
    seen = np.zeros((6, 3), int)
    for r in sharding.shuffle_into_shards(rows, 3, seed=5).collect():
        seen[r["id"] // 1000, r["shard"]] += 1
    assert abs(seen - 333.3).max() < 80


def test_op3_query(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_hypergeometric_shards"](spark, SMOKE).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]), "rows")


# SimHash

def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, radius):
    """marks: (id, fingerprint); returns the smallest id reachable for each row."""
    label = list(range(len(marks)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j][1]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(marks):
        least[root(i)].append(k)
    return [min((k for k in least[root(i)] if k is not None), default=None) for i in range(len(marks))]


def test_simhash_odd_rows(spark):
    rows = simhash.near_duplicates(odd_docs(spark)).collect()
    marks = [(i, plain_fingerprint(t)) for i, t in ODD]
    want = Counter((i, f, c) for (i, f), c in zip(marks, plain_components(marks, 4)))
    assert Counter((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == len({c for c in plain_components([(n, f) for n, (_, f) in enumerate(marks)], 4)})
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []


def test_op4_query(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    marks = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs]
    want = {i: (format(f, "016x"), c) for (i, f), c in zip(marks, plain_components(marks, 4))}
    rows = queries.QUERIES["op4_simhash"](spark, SMOKE).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("tree_rows,shard_rows", [(4096, 256), (3, 256), (5, 1e-9)])
def test_links_of_dense_clusters(spark, monkeypatch, tree_rows, shard_rows):
    """Large shards, split trees and more blocks give the same components."""
    monkeypatch.setattr(simhash, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    r = np.random.default_rng(3)
    values = set()
    for centre in r.integers(0, 2**63, 8).tolist() + [0, 2**64 - 1]:
        for _ in range(40):
            values.add(centre ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 8), replace=False)))
    values = sorted(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    labels = simhash.components(simhash.near_links(spark.createDataFrame(signed, "fingerprint bigint"), 4))
    got = {r["node"] % 2**64: r["label"] % 2**64 for r in labels.collect()}
    want = plain_components([(v, v) for v in values], 4)
    names = defaultdict(set)
    for v, w in zip(values, want):
        names[w].add(got.get(v, v))
    assert all(len(x) == 1 for x in names.values()) and len({next(iter(x)) for x in names.values()}) == len(names)


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {(r["node"], r["label"]) for r in simhash.components(links).collect()} == {(i, 0) for i in range(1, 301)}


# Repeated windows

def plain_removed(docs, window):
    seen, out = set(), []
    for text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if b[i : i + window] in seen:
                gone[i : i + window] = True
            seen.add(b[i : i + window])
        out.append((b, gone))
    return out


def same_removed(rows, want):
    got = []
    for r in rows:
        gone = np.zeros(r["n_bytes"], bool)
        for s in r["spans"]:
            assert s["length"] > 0 and not gone[max(0, s["start"] - 1) : s["start"] + s["length"]].any()
            gone[s["start"] : s["start"] + s["length"]] = True
        got.append((gone.tobytes(), bytes(r["kept"])))
    return Counter(got) == Counter((g.tobytes(), np.frombuffer(b, np.uint8)[~g].tobytes()) for b, g in want)


@pytest.mark.parametrize("limit", [1 << 14, 1])
@pytest.mark.parametrize("window", [33, 100, 280])
def test_suffix_odd_rows(spark, window, limit):
    rows = sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0))
    # One partition keeps the order in which rows of one id are read.
    docs = odd_docs(spark, rows).coalesce(1).sortWithinPartitions(F.col("doc_id").isNull(), "doc_id")
    out = suffix_dedup.remove_repeats(docs, window=window, group_contexts=limit).collect()
    by_order = [r for r in rows]
    fives = [t for i, t in by_order if i == 11]
    nulls = [t for i, t in by_order if i is None]
    head = [t for i, t in by_order if i is not None and i != 11]
    k = sum(1 for i, _ in by_order if i is not None and i < 11)
    options = [
        plain_removed(head[:k] + a + head[k:] + b, window) for a in (fives, fives[::-1]) for b in (nulls, nulls[::-1])
    ]
    assert any(same_removed(out, w) for w in options)


def test_suffix_chunks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    texts = [prose(20, 900), "zz " + prose(20, 900)[50:] + PASSAGE, "q" * 5000, PASSAGE * 3]
    anchors = [suffix_dedup.anchored_runs(t.encode(), 100) for t in texts]
    assert all(a[2].sum() == len(t.encode()) - 99 for a, t in zip(anchors, texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert same_removed(suffix_dedup.remove_repeats(docs).collect(), plain_removed(texts, 100))


def test_suffix_whole_characters_and_empty(spark):
    texts = ["é" * 99 + "x" + "ü" * 60, "ß" + "é" * 99 + "x" + "ü" * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in suffix_dedup.remove_repeats(docs, whole_characters=True).collect():
        bytes(r["kept"]).decode()
    assert suffix_dedup.remove_repeats(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, window=20)


def test_op6_query(spark):
    docs = sorted(spark.read.parquet(f"{SMOKE}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_suffix_dedup"](spark, SMOKE).collect()}
    for d, (b, gone) in zip(docs, plain_removed([d["text"] for d in docs], 100)):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
        assert tuple(rows[d["doc_id"]]) == (d["doc_id"], len(b), int(gone.sum()), spans, kept)


# Quality rules and classifier

def test_rules_odd_rows(spark):
    good = spark.createDataFrame([(4,), (4,), (None,), (777,)], "doc_id bigint")
    rows = quality_rules.apply_rules(odd_docs(spark), good).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words) and r["n_grams"] == max(0, 2 * len(words) - 1)
        assert not (r["kept"] and r["base_failed"])
        if not words:
            assert r["base_failed"] and not r["kept"]
    nothing = quality_rules.apply_rules(odd_docs(spark), good.filter("doc_id = 777")).collect()
    assert all(r["score_sum"] == 0 and r["kept"] == (not r["base_failed"]) for r in nothing)
    assert quality_rules.apply_rules(empty_docs(spark), good).collect() == []


def test_rules_shuffled_join_gives_the_same(spark, monkeypatch):
    good = spark.createDataFrame([(4,), (6,)], "doc_id bigint")
    a = quality_rules.apply_rules(odd_docs(spark), good).select("text", "score_sum", "kept")
    first = Counter(map(tuple, a.collect()))
    monkeypatch.setattr(quality_rules, "TRUSTED_BROADCAST_ROWS", 0)
    b = quality_rules.apply_rules(odd_docs(spark), good).select("text", "score_sum", "kept")
    assert Counter(map(tuple, b.collect())) == first


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_rules_keep_held_out_good_labels(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").collect()}
    held = {i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    good = spark.createDataFrame([(i,) for i, q in labels.items() if q == 1 and i not in held], "doc_id bigint")
    lost = defaultdict(list)
    for r in quality_rules.apply_rules(docs, good).select("doc_id", "lang", "base_failed", "kept").collect():
        if not r["base_failed"]:
            q = labels.get(r["doc_id"])
            kind = "bad" if q == 0 else "unlabelled" if q is None else "held" if r["doc_id"] in held else "trusted"
            lost[kind, r["lang"]].append(not r["kept"])
            lost[kind].append(not r["kept"])
    assert np.mean(lost["bad"]) >= 0.9
    for lang in ("en", "de", "es", "fr"):
        assert np.mean(lost["held", lang]) <= 0.05 and np.mean(lost["trusted", lang]) <= 0.05
        assert np.mean(lost["unlabelled", lang]) <= 0.12  # junk has no label here


def test_rules_verdict_does_not_depend_on_being_trusted(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{SMOKE}/labels.parquet").filter("quality = 1").select("doc_id")
    scores = {r["doc_id"]: r["score_sum"] for r in quality_rules.apply_rules(docs, good).collect()}
    for i in sorted(r["doc_id"] for r in good.collect())[:3]:
        others = quality_rules.apply_rules(docs, good.filter(F.col("doc_id") != i))
        assert others.filter(F.col("doc_id") == i).first()["score_sum"] == scores[i]


def test_pairwise_sum_identity():
    r = np.random.default_rng(0)
    m = classifier.FactorisationMachine(0.3, r.normal(size=30), r.normal(size=(30, 4)))
    index, value = np.array([2, 5, 11, 29]), r.normal(size=4)
    z = 0.3 + m.linear[index] @ value
    for a in range(4):
        for b in range(a):
            z += m.factors[index[a]] @ m.factors[index[b]] * value[a] * value[b]
    assert abs(m.score(index, value) - 1 / (1 + np.exp(-z))) < 1e-12


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op8_quality_classifier"](spark, sf).collect()
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.9


def test_classifier_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 1), (9, 0), (12, 0), (None, 1), (7, None), (99, 0)], "doc_id bigint, quality int")
    model = classifier.train(docs, labels)
    rows = classifier.score(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    same = Counter(r["score"] for r in rows if r["doc_id"] == 5)
    assert list(same.values()) == [2]
    constant = classifier.train(empty_docs(spark), labels)
    assert {r["score"] for r in classifier.score(docs.drop("n_chars"), constant).collect()} == {0.5}
    assert classifier.score(empty_docs(spark), model).collect() == []


# Chat

TURNS = st.lists(
    st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "<|im_start|>", "100%0A", ""]),
              st.text(alphabet="<|\\>im_startend \n%", max_size=25) | st.sampled_from(["<|im_end|>\n<|im_start|>assistant\nok", "<\\|", "<\\\\|x"])),
    min_size=1, max_size=4,
)


def test_chat_round_trip(spark):
    seen = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(TURNS)
    def gather(turns):
        seen.append(turns)

    gather()
    rows = [(c, k, role, text) for c, turns in enumerate(seen) for k, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_chat(df).select(
        "conv_id", "round_trip", chat.parse(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    for r in out.collect():
        turns = seen[r["conv_id"]]
        assert r["round_trip"] and [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")


def test_chat_odd_rows(spark):
    rows = [(1, None, None, None), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (None, 1, "user", "x" * 100_000), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("old"))
    out = {r["conv_id"]: r for r in chat.format_chat(df).withColumn("turns", chat.parse(F.col("formatted"))).collect()}
    assert [tuple(t) for t in out[1]["turns"]] == [("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert [s["length"] for s in out[1]["loss_spans"]] == [1, 1, 1]
    assert out[None]["turns"][0]["text"] == "x" * 100_000 and out[None]["loss_spans"] == []
    assert chat.format_chat(df.limit(0)).collect() == []


def test_exact_index_reopened(spark, tmp_path):
    """The number of buckets stays with the index; another one is refused instead of giving wrong results."""
    place = str(tmp_path / "index")
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    with exact_dedup.DigestIndex(spark, place, buckets=8) as index:
        assert exact_dedup.dedup_exact(docs, index).filter("kept").count() == 300
        name = index.name
    assert not spark.catalog.tableExists(name)
    for buckets in (4, 16):
        with pytest.raises(ValueError):
            exact_dedup.DigestIndex(spark, place, buckets=buckets)
    for buckets in (8, None):
        with exact_dedup.DigestIndex(spark, place, buckets=buckets, expected=10**9) as index:
            found = exact_dedup.dedup_exact(docs.union(spark.createDataFrame([(900, "new")], docs.schema)), index)
            assert index.buckets == 8 and found.filter("kept").count() == (1 if buckets else 0)
    docs.write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, str(tmp_path / "other"))
    with exact_dedup.DigestIndex(spark, expected=150_000_000) as index:
        assert index.buckets == 150


def test_chat_twin_on_conflicting_rows(spark, tmp_path):
    texts = ["see <|endoftext|> here", "<|im_end|>", "<|im_start|>x", "a<\\|b", "<\\\\|", "plain <| text", "<|im_end|", "<", None]
    roles = ["user", "assistant", "a%b", "a%25b", "x%0Ay", "line\nfeed", "<|im_start|>", "<|im_end|>", "<\\|r", None]
    rows = [(c, t, role, text) for c, role in enumerate(roles) for t, text in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(str(tmp_path / "c"))
    (tmp_path / "c").rename(tmp_path / "conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    problems, _ = compare(spark, con, "op9_chat_format", queries.QUERIES["op9_chat_format"], queries.ORACLES["op9_chat_format"], str(tmp_path))
    assert not problems, problems


@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), max_size=60))
@settings(max_examples=300, deadline=None)
def test_repeated_words_equal_counting_windows(words):
    windows = list(zip(*[words[i:] for i in range(5)]))
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        covered |= set(range(i, i + 5)) if n[w] > 1 else set()
    assert quality_rules.repeated_words(words) == len(covered)


def test_very_long_texts(spark, tmp_path):
    """A text of some megabytes passes every operator whole."""
    from lendlake.llm import packing, token_files, word_tokens

    long = " ".join(f"w{i % 50_021}" for i in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, "short one"), (3, long + " end")], "doc_id bigint, text string")
    judged = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, docs.select("doc_id").limit(0)).collect()}
    assert judged[1]["n_words"] == 400_000 and judged[1]["n_repeat_words"] == 400_000
    assert sharding.shuffle_into_shards(docs, 2).count() == 3
    near = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert near[1]["component_id"] == near[3]["component_id"] == 1
    with exact_dedup.DigestIndex(spark) as index:
        assert exact_dedup.dedup_exact(docs, index).filter("kept").count() == 3
    cut = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).select("doc_id", "kept", "n_bytes").collect()}
    assert cut[1]["n_bytes"] == len(long) and bytes(cut[2]["kept"]) == b"short one" and len(cut[3]["kept"]) < 400
    tokens = word_tokens.encode(docs, queries.WORDS, end_id=0)
    n = {r["doc_id"]: r["n"] for r in tokens.select("doc_id", (F.octet_length("ids") / 4).cast("int").alias("n")).collect()}
    packed = packing.pack(packing.cut(tokens, 2048).select("doc_id", "piece", "start", "length"), 2048).collect()
    assert {i: sum(r["length"] for r in packed if r["doc_id"] == i) for i in n} == n
    token_files.write(docs, str(tmp_path / "ids"), queries.WORDS, end_id=1)
    assert {r["doc_id"]: r["n_tokens"] for r in token_files.read(spark, str(tmp_path / "ids")).collect()} == n
    model = classifier.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int"))
    assert classifier.score(docs, model).count() == 3
