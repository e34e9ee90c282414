"""Cheapest repair of the turn structure of conversations, by grammar-compressed dynamic programming.

A row becomes one symbol: the class of its role and its first fault.  The
symbol sequences of all conversations are compressed by one Re-Pair grammar:
again and again the most frequent pairs of neighbouring symbols become new
symbols.  Each symbol, and then bottom-up each rule, gets one min-plus transfer
matrix over the four states of the target grammar ``(s?(ua)+)?``; an entry
holds the least cost and the audit (edit letters) as a rope that shares the
ropes of the rule's two parts.  A conversation is one product of the matrices
of its compressed symbols, so what its parts have in common with others is
evaluated once, on the driver, and broadcast.

Entries are compared by cost, then by audit.  Two audits of one cost over the
same rows are never a proper prefix of one another (the longer would have only
more insertions), so the order survives appending on either side and the
products are exact.

Edits: Keep 0; Rerole to user or assistant 1; Delete 2 (required for blank and
duplicate rows); Insert an empty user or assistant row 5; a truncated row that
stays costs 5 more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby, zip_longest

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.arrow import map_batches
from lendlake.llm.common import WHITESPACE, join_by_size, numbered, stored

# Fixed values of the repair.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
ENDINGS = ".!?"
ROLES = "sua"  # initials of system, user, assistant; any other role is class 3
NAMES = {"u": "user", "a": "assistant"}
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)

# States: nothing yet, after the system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)

SEGMENT_BITS = 10  # rows of a segment, as a power of two
ROUNDS, RULES_A_ROUND = 6, 8
FIRST_RULE = 0x4E00  # code point of the first new symbol; none is a surrogate or a regex character
MEMO_ENTRIES = 50_000


# Damage: the given deterministic faults


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv`` (string), ``turn, role, text`` of the rows that are left, damaged by a hash of conversation and turn.

    Nulls count as one space, except that a null turn stays null.
    """
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    rows = rows.select(space(conv).alias("conv"), F.col(f"`{turn}`").alias("turn"), space(role).alias("role"), space(text).alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    bare = F.translate("text", ENDINGS, "")
    return rows.filter("kind != 0").select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, bare).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


# Symbols


def symbol(role: Column, fault: Column) -> Column:
    """One letter from A to P for the class of a role and a fault."""
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.chr((place + 4 * fault + ord("A")).cast("long"))


def parts(letter: str) -> tuple[int, int]:
    """Role class and fault of a symbol."""
    fault, role = divmod(ord(letter) - ord("A"), 4)
    return role, fault


def segments(rows: DataFrame) -> DataFrame:
    """``conv, segment, seq``: the symbols of each conversation, by at most ``2 ** SEGMENT_BITS`` rows.

    ``rows`` has ``place`` (its order), ``conv, role, text``.  A row is a
    duplicate if its role and text stand at a smaller place of its conversation;
    the first place of each is found by partial aggregation, and rows of often
    repeated texts stay where they are (``join_by_size``).
    """
    body = F.rtrim(F.col("text"), F.lit(WHITESPACE))
    same = F.unhex(F.sha2(F.concat_ws(":", "conv", F.length("role").cast("string"), "role", "text").cast("binary"), 256))
    narrow = stored(
        rows.select(
            "place",
            "conv",
            F.substring("role", 1, 1).alias("initial"),
            (body == "").alias("blank"),
            (~F.substring(body, -1, 1).isin(*ENDINGS)).alias("open"),
            same.alias("same"),
        ),
        "conversation-rows",
    )
    groups = narrow.groupBy("same").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    marked = join_by_size(narrow, groups, "same", "size", narrow.count())
    fault = F.when(F.col("blank"), BLANK).when(F.col("place") != F.col("first"), DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(CLEAN)
    one = F.struct("place", symbol(F.col("initial"), fault).alias("symbol"))
    in_order = F.array_sort(F.collect_list(one))
    return marked.groupBy("conv", F.shiftright("place", SEGMENT_BITS).alias("segment")).agg(
        F.array_join(F.transform(in_order, lambda x: x["symbol"]), "").alias("seq")
    )


# The grammar

Rule = tuple[str, str]  # new symbol, pair


def compressed(seq: Column, rules: list[Rule]) -> Column:
    for new, pair in rules:
        seq = F.replace(seq, F.lit(pair), F.lit(new))
    return seq


def learn(kinds: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_A_ROUND) -> list[Rule]:
    """Rules for the most frequent pairs in ``seq`` (each counted ``n`` times), ``rounds * per_round`` at most.

    The pairs of one round have no symbol in common, so none takes an
    occurrence from another and their order does not matter.  Counts of a
    doubled symbol include overlaps.  Counts only choose the rules: any rules
    give the same repairs.
    """
    rules: list[Rule] = []
    for _ in range(rounds):
        packed = kinds.select(compressed(F.col("seq"), rules).alias("seq"), "n").filter(F.length("seq") > 1)
        places = F.sequence(F.lit(1), F.length("seq") - 1)
        pairs = packed.select(F.explode(F.transform(places, lambda i: F.substr("seq", i, F.lit(2)))).alias("pair"), "n")
        counted = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        taken: set[str] = set()
        for row in counted.orderBy(F.desc("n"), "pair").limit(8 * per_round).collect():
            if len(taken) < 2 * per_round and not taken & set(row["pair"]):
                taken |= set(row["pair"])
                rules.append((chr(FIRST_RULE + len(rules)), row["pair"]))
        if not taken:
            break
    return rules


# Min-plus matrices with audit ropes

Rope = str | tuple  # a text, or two ropes in order
Entry = tuple[int, Rope] | None  # cost and audit; None: no way


def letters(rope: Rope) -> Iterator[str]:
    """The letters of a rope, without building it."""
    left = [rope]
    while left:
        part = left.pop()
        if isinstance(part, str):
            yield from part
        else:
            left += (part[1], part[0])


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    for x, y in zip_longest(letters(a[1]), letters(b[1]), fillvalue=""):
        if x != y:
            return a if x < y else b
    return a


def joined(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return None
    return a[0] + b[0], (a[1], b[1]) if a[1] and b[1] else a[1] or b[1]


def times(row: list[Entry], matrix: list[list[Entry]]) -> list[Entry]:
    """A row of entries times a matrix."""
    out: list[Entry] = [None] * 4
    for a, line in zip(row, matrix):
        if a is not None:
            for j, b in enumerate(line):
                if b is not None:
                    out[j] = better(out[j], joined(a, b))
    return out


def inserts() -> list[list[Entry]]:
    """The cheapest insertions from state to state; none need more than two rows."""
    i = COST["I"]
    none, one, two = (0, ""), (i, "I"), (2 * i, "II")
    return [[none, None, one, two], [None, none, one, two], [None, None, none, one], [None, None, one, none]]


def row_matrix(role: int, fault: int) -> list[list[Entry]]:
    """Edits of one row, insertions before it included."""
    edits: list[list[Entry]] = [[None] * 4 for _ in range(4)]

    def edge(a: int, b: int, letter: str, more: int = 0) -> None:
        edits[a][b] = better(edits[a][b], (COST[letter] + more, letter))

    for state in range(4):
        edge(state, state, "D")
    if fault in (CLEAN, TRUNCATED):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if role == 0:
            edge(EMPTY, SYSTEM, "K", more)
        for to, froms in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for state in froms:
                edge(state, to, "R", more)
                if role == to - 1:
                    edge(state, to, "K", more)
    return [times(line, edits) for line in inserts()]


@dataclass
class Part:
    """What a symbol or rule stands for: its matrix, and counts that add up."""

    matrix: list[list[Entry]]
    first: int
    last: int
    counts: tuple[int, int, int, int]  # blank, duplicate, truncated, illegal neighbours


def illegal(left: int, right: int) -> int:
    return (left, right) not in ((0, 1), (1, 2), (2, 1))


def grammar(rules: list[Rule]) -> dict[str, Part]:
    """All symbols and rules, evaluated bottom-up."""
    known = {}
    for i in range(16):
        role, fault = parts(letter := chr(ord("A") + i))
        counts = tuple(int(fault == f) for f in (BLANK, DUPLICATE, TRUNCATED))
        known[letter] = Part(row_matrix(role, fault), role, role, (*counts, 0))
    for new, (left, right) in rules:
        a, b = known[left], known[right]
        counts = tuple(map(sum, zip(a.counts, b.counts, (0, 0, 0, illegal(a.last, b.first)))))
        known[new] = Part([times(line, b.matrix) for line in a.matrix], a.first, b.last, counts)
    return known


class Evaluator:
    """Runs along the segments of one conversation after another."""

    START: list[Entry] = [(0, ""), None, None, None]

    def __init__(self, rules: list[Rule], known: dict[str, Part]):
        self.rules, self.known = rules, known
        self.memo: dict[str, tuple] = {}

    def run(self, seqs: Iterator[str]) -> tuple:
        """(blank, duplicate, truncated, illegal, cost, audit) of a conversation's segments in order."""
        row, last, counts = self.START, None, (0, 0, 0, 0)
        for seq in seqs:
            for new, pair in self.rules:
                seq = seq.replace(pair, new)
            for letter in seq:
                part = self.known[letter]
                between = last is not None and illegal(last, part.first)
                row, last = times(row, part.matrix), part.last
                counts = tuple(map(sum, zip(counts, part.counts, (0, 0, 0, between))))
        row = times(row, inserts())
        cost, audit = better(row[EMPTY], row[ASSISTANT])
        return (*counts, cost, "".join(letters(audit)))

    def one(self, seq: str) -> tuple:
        """``run`` of a conversation of one segment, remembered."""
        found = self.memo.get(seq)
        if found is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            found = self.memo[seq] = self.run([seq])
        return found


OUTPUTS = ("blank", "duplicate", "truncated", "illegal", "cost")
AUDIT_SCHEMA = "conv string, " + ", ".join(f"{c} bigint" for c in OUTPUTS) + ", audit string"


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def records(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches."""
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*some), schema)], schema=schema)


def audits(pieces: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, least cost and its audit of every conversation in ``pieces`` (``conv, segment, seq``).

    Conversations stream through a task in the order of their segments; of a
    long one the task holds four audits, no rows.
    """
    shared = pieces.sparkSession.sparkContext.broadcast((rules, grammar(rules)))
    schema = pa.schema([("conv", pa.string()), *[(c, pa.int64()) for c in OUTPUTS], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evaluator = Evaluator(*shared.value)

        def found() -> Iterator[tuple]:
            for conv, group in groupby(rows_of(batches, "conv", "seq"), lambda r: r[0]):
                seqs = (seq for _, seq in group)
                first, second = next(seqs), next(seqs, None)
                yield (conv, *(evaluator.one(first) if second is None else evaluator.run(chained(first, second, seqs))))

        yield from records(found(), schema)

    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "segment")
    return map_batches(ordered.select("conv", "seq"), run, AUDIT_SCHEMA)


def chained(first: str, second: str, rest: Iterator[str]) -> Iterator[str]:
    yield first
    yield second
    yield from rest


# Applying the audit


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows of one conversation, in a stream."""
    before = None  # initial of the last row given out
    todo = iter(rows)
    for letter in audit:
        if letter == "I":
            role, text = NAMES["a" if before == "u" else "u"], ""
        else:
            role, text = next(todo)
            if letter == "D":
                continue
            if letter == "R":
                role = NAMES["a" if before == "u" else "u"]
        before = role[0]
        yield role, text


def apply_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, place, role, text``: the repaired rows of every conversation, ``place`` counting from 0."""
    schema = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def emit(conv: str, repaired: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        return ((conv, i, role, text) for i, (role, text) in enumerate(repaired))

    return _streamed(rows, found, emit, schema, "conv string, place bigint, role string, text string", 100)


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: ``role:text`` of the repaired rows, joined by line feeds, hashed in a stream."""
    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])

    def emit(conv: str, repaired: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        digest = sha256()
        for i, (role, text) in enumerate(repaired):
            digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        yield conv, digest.hexdigest()

    return _streamed(rows, found, emit, schema, "conv string, repaired_sha256 string", 1000)


def _streamed(rows: DataFrame, found: DataFrame, emit, schema: pa.Schema, ddl: str, size: int) -> DataFrame:
    """``emit(conv, repaired rows)`` for every conversation, whose audit comes as a record before its rows."""
    marks = found.select("conv", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"))
    ordered = rows.select("conv", "place", "role", "text").unionByName(marks).repartition("conv").sortWithinPartitions("conv", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, group in groupby(rows_of(batches, "conv", "role", "text"), lambda r: r[0]):
                stream = ((role, text) for _, role, text in group)
                yield from emit(conv, edited(next(stream)[1], stream))

        yield from records(out(), schema, size)

    return map_batches(ordered, run, ddl)


@dataclass
class Repair:
    """``rows`` in order (``place``), the audits of their conversations, and the rules that were learned."""

    rows: DataFrame
    audits: DataFrame
    rules: list[Rule]

    def repaired(self) -> DataFrame:
        return apply_audits(self.rows, self.audits)

    def digests(self) -> DataFrame:
        return repaired_digests(self.rows, self.audits)


def repair(rows: DataFrame) -> Repair:
    """Repair the conversations in ``rows`` (``conv, turn, role, text``; ``conv``, role and text not null).

    Rows of a conversation come by turn, null turns first, then by role and
    text; repeated rows are duplicates of the first.  Empty texts and texts of
    white space are blank.  A role that does not begin with s, u or a can only be
    changed or deleted.  An empty table gives empty tables.

    Rows are numbered by ranges of that order, so a conversation that holds
    most of the table is ordered, marked and cut into segments by many tasks;
    what runs along a conversation in one task is one letter a row for the
    audit, and its repaired text for the digest of the whole.
    """
    ordered = numbered(rows.select("conv", "turn", "role", "text"), ["conv", "turn", "role", "text"], "conversations-in-order")
    pieces = stored(segments(ordered), "conversation-segments")
    kinds = pieces.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    rules = learn(stored(kinds, "conversation-kinds"))
    return Repair(ordered, stored(audits(pieces, rules), "conversation-audits"), rules)
