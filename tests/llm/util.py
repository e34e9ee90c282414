"""Small documents with every odd case, for all operators."""

import random

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew très étrange potions für alle".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice(["", "", ".", "\n"])) for _ in range(n))


PASSAGE = prose(99, 40)

ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, prose(1, 200)), (5, prose(1, 200)), (5, prose(1, 200)),
    (6, prose(2, 60) + PASSAGE), (7, PASSAGE + prose(3, 50)), (8, prose(4, 5000)), (9, "x" * 3000),
    (None, prose(5, 30)), (None, None), (10, "one"), (11, "日本語   émoji 😀 <|endoftext|> a\x1cb"),
    (11, "other text, same id " + PASSAGE), (12, "ab" * 700 + "\n" + "ab" * 200), (13, prose(1, 200).replace(" ", "  ")),
]
CLASH = [
    "ids", "decoded", "shard", "slot", "kept", "score", "fingerprint", "component_id", "spans", "n_bytes",
    "sequence_id", "offset", "piece", "start", "length", "group_size", "keep_id", "row_hash", "n_words", "base_failed",
    "score_sum", "n_grams", "block", "part", "row", "digest", "label", "anchor", "place",
]


def odd_docs(spark, rows=ODD, clash=True):
    schema = "doc_id bigint, text string, n_chars bigint"
    data = [(i, t, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, schema).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"old {c}").alias(c) for c in CLASH])
    return df


def empty_docs(spark):
    return odd_docs(spark, []) if False else spark.createDataFrame([], "doc_id bigint, text string, n_chars bigint")
