"""Near-duplicate groups by SimHash, searched in BK-trees.

A fingerprint has 64 bits.  Two that differ in at most ``radius`` bits agree in
all but ``radius`` of any ``radius + k`` blocks of bits, so for every choice of
``k`` blocks the fingerprints are dealt out by those blocks' bits.  Each such
group is a shard: its fingerprints form a BK-tree (children keyed by their
Hamming distance to the parent), and a search follows only the edges within
``radius`` of the distance to the node.  ``k`` follows from the number of
distinct fingerprints, so that shards stay small at any size; the search is
exact for every ``k``.

A shard goes to its queries by the exchange that forms it, not by a broadcast:
a tree that every query could need has no bound on its size.  Shards over
``TREE_ROWS`` are split into several trees, and each is searched by the later
ones' fingerprints.  A task does not report pairs but one link from each found
fingerprint to its neighbour in the tree and from tree nodes to their group's
first, which keeps all connections; components then come from rounds of
large-star and small-star steps on stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, text_bytes, with_column
from lendlake.llm.common import join_by_size, stored, text_or_empty

TREE_ROWS = 4096
SHARD_ROWS = 256
MASK_64 = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    starts = list(accumulate([len(w) + 1 for w in words], initial=0))
    ends = starts[min(shingle, len(words)) :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 14):
        part = zip(starts[i : min(n, i + (1 << 14))], ends[i:])
        hashes = np.array([digest(joined[a : b - 1], seed) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with its text replaced by the SimHash of the whole text (bigint)."""
    drop = [text, out]
    schema = replaced_schema(docs, drop, T.StructField(out, T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text):
            marks = [fingerprint(x, shingle) for x in text_bytes(batch.column(text))]
            yield with_column(batch, drop, out, pa.array(marks, pa.int64()))

    return map_batches(docs, run, schema)


class BKTree:
    """Distinct 64-bit fingerprints by Hamming distance, with their components."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children, self.parent = radius, [], [], []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def near(self, value: int) -> list[int]:
        """Nodes within the radius."""
        found, radius = [], self.radius
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        return found

    def join(self, nodes: list[int]) -> None:
        for node in nodes[1:]:
            a, b = self.root(nodes[0]), self.root(node)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def add(self, value: int) -> None:
        near, new = self.near(value), len(self.values)
        if self.values:
            node = 0
            while True:
                d = (self.values[node] ^ value).bit_count()
                if d not in self.children[node]:
                    self.children[node][d] = new
                    break
                node = self.children[node][d]
        self.values.append(value)
        self.children.append({})
        self.parent.append(new)
        self.join([new, *near])

    def links(self) -> list[tuple[int, int]]:
        return [(v, self.values[r]) for i, v in enumerate(self.values) if (r := self.root(i)) != i]


def block_masks(count: int, radius: int) -> list[int]:
    """Bit masks such that any two values within ``radius`` agree under one of them.

    With b blocks there are C(b, radius) masks of b - radius blocks each.  The
    least b is taken that leaves about ``SHARD_ROWS`` random values a shard.
    """
    for blocks in range(radius + 1, radius + 5):
        if count / 2 ** (64 * (blocks - radius) / blocks) <= SHARD_ROWS:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    assert len(masks) == comb(blocks, radius)
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(marks: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all distinct values within ``radius`` bits.

    ``marks`` holds distinct values in ``fingerprint``.  Every two values
    within the radius end up connected by links; no link joins two values that
    are not connected by such steps.
    """
    masks = block_masks(marks.count(), radius)
    shards = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    keyed = marks.select("fingerprint", F.explode(shards).alias("shard")).select("fingerprint", "shard.t", "shard.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    trees = F.ceil(F.col("n") / TREE_ROWS).cast("int")
    rows = (
        keyed.join(sizes, ["t", "key"])
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), trees).cast("int"))
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("own"))))
        .select("t", "key", "tree", (F.col("own") != F.col("tree")).alias("guest"), "fingerprint")
    )
    order = ["t", "key", "tree", "guest", "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = BKTree(radius), None

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            signed = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], names=["a", "b"])

        for batch in batches:
            links = []
            for t, key, number, guest, value in zip(*[batch.column(c).to_pylist() for c in order]):
                value &= MASK_64  # Python's numbers have no sign bit to compare
                if (t, key, number) != at:
                    links += tree.links()
                    tree, at = BKTree(radius), (t, key, number)
                if guest:
                    near = tree.near(value)
                    tree.join(near)
                    links += [(value, tree.values[near[0]])] if near else []
                else:
                    tree.add(value)
            yield out(links)
        yield out(tree.links())

    dealt = rows.repartition("t", "key", "tree").sortWithinPartitions(*order)
    return map_batches(dealt, run, "a bigint, b bigint")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """For each value of a link (a, b): ``node`` and ``label``, the least value connected.

    Alternates large-star and small-star until nothing changes; each round is
    written, so lost executors cost one round.  Values without links have no row.
    """

    def undirected(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))

    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _signature(edges)
    while seen[0]:
        both = undirected(edges)
        large = both.join(least(both), "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, kept, row_hash``.

    ``fingerprint`` is a bigint.  Rows are in one component if steps of at most
    ``radius`` bits lead from one to the other; ``component_id`` is its smallest
    id (null if all ids are).  ``kept`` is true for one row of each component:
    the smallest id (null ids last), then the first row read.  ``row_hash`` is
    ``xxhash64(text)``.  Null texts and texts without words have fingerprint
    zero and link like any other; repeated rows share a component; an empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        text_or_empty(text).alias("text"),
        F.xxhash64(text_or_empty(text)).alias("row_hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(fingerprints(rows, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    marks = stored(rows.groupBy("fingerprint").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("n")), "marks")
    links = stored(near_links(marks.select("fingerprint"), radius), "near-links")
    labels = components(links)
    labelled = marks.join(labels, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "n", "best", F.coalesce("label", "fingerprint").alias("label")
    )
    labelled = stored(labelled, "labelled")
    bests = labelled.groupBy("label").agg(F.min("best").alias("component"), F.count(F.lit(1)).alias("size"))
    members = join_by_size(labelled, stored(bests, "components"), "label", "size", labelled.count())
    members = stored(members.select("fingerprint", "n", "component"), "members")
    found = join_by_size(rows, members, "fingerprint", "n", rows.count())
    return found.select(
        "doc_id",
        "fingerprint",
        F.col("component.doc_id").alias("component_id"),
        (F.col("row") == F.col("component.row")).alias("kept"),
        "row_hash",
    )


def hex_fingerprint(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))
