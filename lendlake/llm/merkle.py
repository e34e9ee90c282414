"""Merkle manifest of a dataset: one tree per source, one tree over the sources.

Checkpoint and recompute: of a tree's levels only every ``stride``-th is
written (the leaves, then one node per aligned subtree of ``16 ** stride``
leaves, and so on).  Proof extraction goes from the top down: it gathers the
stored nodes below each stored node, regenerates the levels in between from
them, emits the siblings of every node on the way and lets the regenerated
levels go again.

A leaf is the SHA-256 of a row's fields, each as its length in UTF-8 bytes, a
colon and the value, or ``-`` for null.  A node is the SHA-256 of its children's
hex digests; every 16 neighbours have one parent (the last run may be shorter,
even one) until one node is left.

No tree is gathered anywhere: leaves are numbered by ranges, a group is one
aligned subtree (``16 ** stride`` nodes at most), and a tree of n leaves takes
log(n) / stride rounds of partial size.  All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.common import join_by_size, numbered, stored

# Fixed values of the manifest format.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 4  # sixteen children

STRIDE = 2


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return sha(F.concat(*map(field, values)))


def _width(size: Column, level: int) -> Column:
    """Nodes that a tree of ``size`` nodes has ``level`` levels further up."""
    return F.shiftright(size + ((1 << BITS * level) - 1), BITS * level)


def _parents(nodes: Column) -> Column:
    """The next level above an array of digests."""
    run = lambda i: F.slice(nodes, i * (1 << BITS) + 1, F.lit(1 << BITS))
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, BITS)), lambda i: sha(F.array_join(run(i), "")))


def _subtrees(nodes: DataFrame, stride: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per aligned subtree: ``tree, up, size, members`` and the regenerated ``level 0`` ... ``level stride``.

    A tree that has come down to one node climbs no further.
    """
    member = F.struct("at", "node", *carried)
    out = nodes.groupBy("tree", F.shiftright("at", BITS * stride).alias("up")).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(member)).alias("members")
    )
    out = out.withColumn("level 0", F.transform("members", lambda m: m["node"]))
    for k in range(stride):
        parents = _parents(F.col(f"level {k}"))
        out = out.withColumn(f"level {k + 1}", F.when(_width(F.col("size"), k) > 1, parents).otherwise(F.col(f"level {k}")))
    return out


@dataclass
class Forest:
    """The stored levels of many trees: ``tree, at, size, node`` each; the last holds all roots."""

    levels: list[DataFrame]
    stride: int

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1].select("tree", "node")


def grow(nodes: DataFrame, tallest: int, stride: int, label: str) -> Forest:
    """Write every ``stride``-th level above ``nodes`` (``tree, at, size, node``; ``size`` leaves of the tree, ``tallest`` at most)."""
    levels = [nodes]
    while tallest > 1:
        up = _subtrees(levels[-1].select("tree", "at", "size", "node"), stride)
        top = up.select(
            "tree", F.col("up").alias("at"), _width(F.col("size"), stride).alias("size"), F.col(f"level {stride}")[0].alias("node")
        )
        levels.append(stored(top, f"{label}-{len(levels) * stride}"))
        tallest = (tallest + (1 << BITS * stride) - 1) >> BITS * stride
    return Forest(levels, stride)


def paths(forest: Forest, above: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``tree, at, node, path`` of every leaf, and the ``carried`` columns of the leaves.

    ``above`` (``tree, path``) is what follows the root of each tree.  ``path``
    lists, from the leaf up, the siblings' digests to the ``left`` and to the
    ``right``, joined.
    """
    known = above.select("tree", F.lit(0).cast("long").alias("at"), "path")
    if len(forest.levels) == 1:
        return forest.levels[0].join(known, ["tree", "at"]).select("tree", "at", "node", *carried, "path")
    for depth in range(len(forest.levels) - 2, -1, -1):
        known = _down(forest.levels[depth], known, forest.stride, carried if depth == 0 else ())
    return known


def _down(nodes: DataFrame, known: DataFrame, stride: int, carried: tuple[str, ...]) -> DataFrame:
    groups = _subtrees(nodes, stride, carried).join(known.withColumnRenamed("at", "up"), ["tree", "up"])

    def step(k: int) -> Callable[[Column], Column]:
        def siblings(i: Column) -> Column:
            level, place = F.col(f"level {k}"), F.shiftright(i, BITS * k)
            start = F.shiftright(place, BITS) * (1 << BITS)
            left = F.slice(level, start + 1, place - start)
            right = F.slice(level, place + 2, start + ((1 << BITS) - 1) - place)
            found = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
            return F.when(_width(F.col("size"), k) > 1, found)

        return siblings

    steps = [step(k) for k in range(stride)]
    # A step above a tree's root is null and goes out.
    placed = F.transform("members", lambda m, i: F.struct(m.alias("m"), F.filter(F.array(*[s(i) for s in steps]), lambda s: s.isNotNull()).alias("own")))
    rows = groups.select("tree", "path", F.explode(placed).alias("x"))
    return rows.select(
        "tree", *[F.col(f"x.m.{c}").alias(c) for c in ("at", "node", *carried)], F.concat(F.col("x.own"), F.col("path")).alias("path")
    )


@dataclass
class Manifest:
    """``sources`` (``tree, source, rank, size, subroot``), the forest of source trees, the tree over them, its root."""

    forest: Forest
    top: Forest
    sources: DataFrame
    root: str | None
    carried: tuple[str, ...]


def build(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, source: str = "source", doc_id: str = "doc_id",
    carry: dict[str, Column] | None = None, stride: int = STRIDE,
) -> Manifest:
    """Leaves of all rows, the written levels of all trees, and the root.

    Leaves of a source ascend by ``doc_id``, null first; rows of one id by their
    leaf, so ties and repeated rows have one order.  Null ids and sources are
    values of their own and come first; null and empty texts differ.
    ``carry`` adds columns to the leaves (any but ``tree``, ``at``, ``up``, ``size``, ``node``, ``path``).  Columns not in ``fields`` are not
    read and may have any name.  An empty table has no leaves and root None.

    A text is read once and stays where it is; digests are dealt out by ranges
    of (source, id), so a source that holds most rows fills many tasks.
    """
    carry = {"doc_id": F.col(f"`{doc_id}`"), **(carry or {})}
    hashed = docs.select(
        field(F.col(f"`{source}`")).alias("tree"),
        F.col(f"`{source}`").cast("string").alias("source"),
        leaf([F.col(f"`{c}`") for c in fields]).alias("node"),
        *[c.alias(name) for name, c in carry.items()],
    )
    leaves = numbered(stored(hashed, "leaves"), ["source", "doc_id", "node"], "leaves-in-order")
    sources = leaves.groupBy("tree", "source").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("size"))
    sources = numbered(sources, ["start"], "sources").withColumnRenamed("place", "rank")
    total, tallest, trees = sources.agg(F.sum("size"), F.max("size"), F.count(F.lit(1))).first()
    placed = join_by_size(leaves.drop("source"), sources.select("tree", "start", "size"), "tree", "size", total or 0)
    placed = stored(placed.withColumn("at", F.col("place") - F.col("start")).drop("place", "start"), "leaves-placed")
    forest = grow(placed, tallest or 0, stride, "nodes")
    subroots = forest.roots.join(sources, "tree")
    known = stored(subroots.select("tree", "source", "rank", F.col("size"), F.col("node").alias("subroot")), "subroots")
    top_leaves = known.select(
        F.lit("").alias("tree"), F.col("rank").alias("at"), F.lit(trees).cast("long").alias("size"), F.col("subroot").alias("node")
    )
    top = grow(stored(top_leaves, "top-0"), trees, stride, "top")
    first = top.roots.first()
    return Manifest(forest, top, known, first["node"] if first else None, tuple(carry))


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: the carried columns, ``leaf``, ``subroot``, ``path``.

    ``path`` runs from the leaf by its subroot to the root.
    """
    end = F.expr("array()").cast("array<struct<left:string,right:string>>")
    at_top = paths(manifest.top, manifest.top.roots.select("tree", end.alias("path"))).select(F.col("at").alias("rank"), "path")
    above = manifest.sources.join(at_top, "rank").select("tree", F.struct("subroot", "path").alias("above"))
    found = paths(manifest.forest, above.select("tree", F.col("above.path").alias("path")), manifest.carried)
    subroots = manifest.sources.select("tree", "subroot", "size")
    total = manifest.sources.agg(F.sum("size")).first()[0] or 0
    named = join_by_size(found, subroots, "tree", "size", total)
    return named.select(*manifest.carried, F.col("node").alias("leaf"), "subroot", "path")


def proof_text(path: Column) -> Column:
    """All siblings of a path in order, joined."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(node: Column, path: Column) -> Column:
    """The root that follows from ``node`` and its siblings."""
    return F.aggregate(path, node, lambda x, s: sha(F.concat(s["left"], x, s["right"])))
