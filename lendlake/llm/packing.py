"""Best-fit packing of token sequences, improved by swap-based local search.

Pieces are dealt into blocks of bounded size.  In a block, best fit by falling
length gives a first packing.  Local search then takes the emptiest bin and
tries, for its pieces, to move one into another underfull bin, to exchange one
for a shorter one, or two for one.  Every step it takes adds to the sum of
squared fills (a fuller bin gets fuller, an emptier one emptier), until the bin
is empty and goes or no step is left.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import ship_package
from lendlake.llm.common import stored, without


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that takes it."""
    open_bins: dict[int, list[int]] = defaultdict(list)  # by free room
    rooms, bins = 0, []  # rooms: bit r is set if a bin with room r exists
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room > n:
            open_bins[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search over underfull bins; sweeps repeat while they empty bins."""
    least = -(-sum(lengths) // capacity)
    while len(bins) > least:
        before = len(bins)
        bins = _sweep(bins, lengths, capacity, least)
        if len(bins) == before:
            break
    return bins


def _offers(own: list[int], lengths: list[int]) -> Iterator[tuple[int, ...]]:
    """One piece of every length, then a pair of every two lengths; ``own`` is longest first.

    Equal lengths exchange alike.  A bin's distinct lengths add up to at most
    its capacity, so they are few however many pieces it holds.
    """
    kinds: dict[int, list[int]] = defaultdict(list)
    for i in own:
        kinds[lengths[i]].append(i)
    groups = list(kinds.values())
    for a in groups:
        yield (a[0],)
    for k, a in enumerate(groups):
        if len(a) > 1:
            yield (a[0], a[1])
        for b in groups[k + 1 :]:
            yield (a[0], b[0])


def _sweep(bins: list[list[int]], lengths: list[int], capacity: int, least: int) -> list[list[int]]:
    bins = [list(b) for b in bins]
    fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
    places = sorted((i, b) for b, items in enumerate(bins) if fill[b] < capacity for i in items)
    item = np.array([i for i, _ in places], np.int64)
    home = np.array([b for _, b in places], np.int64)
    size = np.array([lengths[i] for i in item], np.int64)
    at = {int(i): k for k, i in enumerate(item)}
    done = np.ones(len(bins), bool)
    done[np.unique(home)] = False
    left = len(bins)

    def put(i: int, b: int) -> None:
        old = home[at[i]]
        bins[old].remove(i)
        bins[b].append(i)
        fill[old] -= lengths[i]
        fill[b] += lengths[i]
        home[at[i]] = b

    while left > least and not done.all():
        b = int(np.where(done, capacity + 1, fill).argmin())
        done[b] = True
        gained = True
        while gained and bins[b]:
            gained = False
            own = sorted(bins[b], key=lambda i: -lengths[i])
            room = capacity - fill
            usable = (room > 0) & (fill >= fill[b]) & (fill > 0)
            usable[b] = False
            for i in own:  # move: into the fullest bin that takes it
                fits = np.flatnonzero(usable & (room >= lengths[i]))
                if len(fits):
                    put(i, int(fits[fill[fits].argmax()]))
                    gained = True
                    break
            if gained:
                continue
            near, most = usable[home], size + room[home]
            # A near piece can be had for any length above its own, up to what its bin then holds.
            starts, ends = (np.bincount(x[near] + 1, minlength=capacity + 2) for x in (size, most))
            open_at = np.cumsum(starts - ends) > 0
            for given in _offers(own, lengths):  # one for one, two for one
                n = sum(lengths[i] for i in given)
                if open_at[n]:
                    ok = np.flatnonzero(near & (size < n) & (most >= n))
                    k = int(ok[size[ok].argmin()])  # the shortest: the most is won
                    target, taken = int(home[k]), int(item[k])
                    put(taken, b)
                    for i in given:
                        put(i, target)
                    gained = True
                    break
        if not bins[b]:
            left -= 1
    return [b for b in bins if b]


def pack(
    pieces: DataFrame,
    capacity: int,
    length: str = "length",
    order: tuple[str, ...] = ("doc_id", "piece"),
    block_rows: int = 8192,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (its place in the sequence).

    Every length must be from 0 to ``capacity``; a null length counts as 0.
    Pass narrow rows: all columns travel to the block.  Blocks have about
    ``block_rows`` rows whatever the size of the table, and each leaves less
    than one bin's room more than packing all at once could; that is the price
    of packing in parallel.  Rows are stored once with a row number that deals
    them into blocks, so repeated rows and null ids are pieces like any other.
    Columns named like the results are replaced.  An empty table gives no rows.
    """
    outputs = ["sequence_id", "offset"]
    rows = stored(
        without(pieces, outputs + ["pack_row", "block"]).withColumn("pack_row", F.monotonically_increasing_id()), "pieces"
    )
    blocks = max(1, -(-rows.count() // block_rows))
    keys, names = [*order, "pack_row"], [c for c in rows.columns if c != "pack_row"]

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(k, "ascending") for k in keys])
        lengths = [n or 0 for n in rows[length].to_pylist()]
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for b, items in enumerate(bins):
            place = 0
            for i in sorted(items):
                sequence[i], offset[i] = b, place
                place += lengths[i]
        block = rows["block"].to_numpy()
        out = rows.select(names)
        return out.append_column("sequence_id", pa.array((block << 32) + sequence)).append_column("offset", pa.array(offset))

    schema = T.StructType([f for f in rows.schema.fields if f.name != "pack_row"])
    schema = schema.add("sequence_id", T.LongType()).add("offset", T.LongType())
    ship_package(rows.sparkSession)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("pack_row"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(run, schema)


def cut(tokens: DataFrame, capacity: int, ids: str = "ids") -> DataFrame:
    """Cut packed ids (binary, 4 bytes each) into pieces of at most ``capacity``.

    Adds ``piece`` (from 0), ``start``, ``length`` and leaves the piece's own
    ids in ``ids``.  Only longer documents are cut; the last piece may be
    shorter.  Rows without ids give no piece.
    """
    n = (F.length(F.col(ids)) / 4).cast("int")
    last = F.ceil(n / F.lit(capacity)).cast("int") - 1
    pieces = without(tokens, ["piece", "start", "length"]).filter(n > 0).withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    mine = F.substring(F.col(ids), F.col("piece") * (4 * capacity) + 1, F.lit(4 * capacity))
    return (
        pieces.withColumn("start", (F.col("piece") * capacity).cast("long"))
        .withColumn(ids, mine)
        .withColumn("length", (F.length(F.col(ids)) / 4).cast("long"))
    )


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and its joined ids (binary).

    A sequence is at most the capacity long, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex(F.col(ids)).alias("part"))))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(parts, lambda x: x["part"]), "")).alias(ids)
    )
