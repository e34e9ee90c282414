"""Byte-level BPE encoding and decoding, exact and in linear time.

Bytes are mapped to Latin-1 characters, so a pyahocorasick automaton over the
vocabulary gives the longest match that starts at a byte.  The encoder takes longest matches from the
left; a token may follow its neighbour only if the two are *compatible*, that
is if merging their bytes alone would give the same two tokens.  Where no token
fits, it steps back and tries the next shorter prefix, and it marks the
position as dead, so no position is left twice.  A sequence whose neighbours
are all compatible is the one that the merges give.  Compatibility depends on
two token ids only and is memoised.

The work runs in Arrow batches on the executors; memory is bounded by the
batch and by the memo sizes.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, list_array, map_batches, replaced_schema, with_columns

MEMO_ENTRIES = 250_000
MEMO_LENGTH = 64


def merge_bytes(piece: str, rank: dict[str, int], below: int) -> list[str]:
    """Plain merging, lowest rank first, by ranks under ``below`` (quadratic)."""
    parts = list(piece)
    while len(parts) > 1:
        ranks = [rank.get(a + b, below) for a, b in zip(parts, parts[1:])]
        least = min(ranks)
        if least >= below:
            break
        i = ranks.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


@lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    """Rank to bytes of a rank file, read once per process."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {int(rank): base64.b64decode(token) for token, rank in pairs}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> pa.Array:
    """Bytes by rank; null where the file has no such rank."""
    known = token_bytes(path)
    return pa.array([known.get(rank) for rank in range(max(known, default=-1) + 1)], pa.large_binary())


def decode_lists(lists: pa.ListArray, path: str) -> pa.Array:
    """The bytes of each list of ids.

    The tokens taken one after the other already are the text: their buffer is
    kept, and only the ends of the lists become the new offsets.
    """
    starts = lists.offsets.to_numpy()
    tokens = vocabulary(path).take(lists.values.slice(starts[0], starts[-1] - starts[0]))
    if tokens.null_count:
        raise ValueError("an id that the rank file lacks")
    _, offsets, data = tokens.buffers()
    ends = np.frombuffer(offsets, np.int64, len(tokens) + 1)[starts - starts[0]]
    found = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), data])
    return found.cast(pa.binary())


class Memo(dict):
    """Results of ``compute`` by key, at most twice ``MEMO_ENTRIES``; long keys are not kept.

    When full, its entries become the old ones, and those in use come back.
    """

    def __init__(self, compute: Callable[[str], bytes]):
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def pair_key(left: int, right: int) -> int:
    return left << 32 | right


class BytePairEncoder:
    """Encoder for one rank file (``base64(token) rank`` lines) and split pattern."""

    def __init__(self, path: str, pattern: str):
        self.rank = {token.decode("latin-1"): rank for rank, token in token_bytes(path).items()}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.pieces = regex.compile(pattern)
        # The two tokens whose merge makes a token; single bytes have none.
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        longest = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            if len(token) > 1:
                parts = merge_bytes(token, self.rank, rank)
                if len(parts) != 2:
                    continue  # no merge reaches it: only a whole piece can be this token
                pair = (self.rank[parts[0]], self.rank[parts[1]])
                self.halves[rank], self.merged[pair] = pair, rank
            longest.add_word(token, rank)
        longest.make_automaton()
        self.longest = longest
        self.reach = max(map(len, self.rank))
        self.size = {rank: len(token) for rank, token in self.token.items()}
        self.shorter: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.words = Memo(self._word)
        self.chunks = Memo(self._spaced)
        # A blank before a non-blank always starts a piece, so texts fall apart there.
        self.blank = re.compile(r" (?=\S)")

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends in just these two."""
        key = pair_key(left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 2 * MEMO_ENTRIES:
                self.fits.clear()
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Undo merges from the highest rank down.  At each state the two tokens
        # that touch across the seam must not have been merged before the
        # merge undone last (``limit``).
        limit = len(self.rank) + 256
        halves, merged = self.halves, self.merged
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                return False
            left_parts, right_parts = halves.get(left), halves.get(right)
            # Of two equal ranks the left one is merged first, so it is undone last.
            if left_parts and (not right_parts or left > right):
                limit, left = left, left_parts[1]
            elif right_parts:
                limit, right = right + 1, right_parts[0]
            else:
                return True

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, or -1."""
        found = self.shorter.get(token)
        if found is None:
            text, found = self.token[token], -1
            for n in range(len(text) - 1, 0, -1):
                rank = self.rank.get(text[:n], -1)
                if rank in self.halves or (rank >= 0 and n == 1):
                    found = rank
                    break
            self.shorter[token] = found
        return found

    def _longest(self, piece: str, pos: int) -> int:
        """The longest token that starts at ``pos``."""
        near = piece[pos : pos + self.reach]
        n = self.longest.longest_prefix(near)  # of some token; it need not be one itself
        token = self.longest.get(near[:n], -1)
        while token < 0:
            n -= 1
            token = self.longest.get(near[:n], -1)
        return token

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one piece, given as Latin-1 text."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        # Longest matches alone are the answer if all neighbours are compatible.
        out = [token for _, token in self.longest.iter_long(piece)]
        known = [self.fits.get(pair) for pair in map(pair_key, out, out[1:])]
        if all(known) or all(self.compatible(a, b) for a, b in zip(out, out[1:])):
            return out
        return self._backtrack(piece)

    def _backtrack(self, piece: str) -> list[int]:
        n, size, fits = len(piece), self.size, self.fits
        alive, out, last, pos = bytearray(b"\x01") * (n + 1), [], -1, 0
        token = self._longest(piece, 0)
        while pos < n:
            end = pos + size[token]
            if alive[end]:
                ok = last < 0 or fits.get(last << 32 | token)
                if ok is None:
                    ok = self.compatible(last, token)
                if ok:
                    out.append(token)
                    last, pos = token, end
                    if pos < n:
                        token = self._longest(piece, pos)
                    continue
            token = self._shorter(token)
            if token < 0:
                alive[pos] = 0
                token = out.pop()
                last = out[-1] if out else -1
                pos -= size[token]
                # The token just taken back ends at a dead place: the loop goes on with its prefixes.
        return out

    def _word(self, piece: str) -> bytes:
        latin = piece if piece.isascii() else piece.encode().decode("latin-1")
        return array("i", self.encode_piece(latin)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pieces.findall(chunk)))

    def _spaced(self, part: str) -> bytes:
        """Ids of a blank and a chunk without blanks."""
        if part.isalpha():
            return self.words[" " + part]
        if part[-1] in ".," and part[:-1].isalpha():
            return self.words[" " + part[:-1]] + self.words[part[-1]]
        return self._chunk(" " + part)

    def encode(self, text: str) -> bytes:
        """Token ids of a text as packed int32."""
        first, *parts = self.blank.split(text)
        return self._chunk(first) + b"".join(map(self.chunks.__getitem__, parts))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> BytePairEncoder:
    """The encoder of a worker process, built once."""
    coder = BytePairEncoder(path, pattern)
    gc.freeze()
    return coder


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep_text: bool = True,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with a column ``ids`` (``array<int>``): the tokens of the whole text.

    Null and empty texts give an empty list.  A column of that name is replaced;
    all others pass unchanged (the text only if ``keep_text``).  Row by row, so
    repeated rows and null ids pass as they are; an empty table stays empty.
    With ``decoded``, the ids are decoded again in the same pass, as ``decode``
    does, into a binary column of that name.
    """
    drop = [ids] + ([] if keep_text else [text]) + ([decoded] if decoded else [])
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    fields += [T.StructField(decoded, T.BinaryType())] if decoded else []
    schema = replaced_schema(docs, drop, *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in by_bytes(batches, text, 2 << 20):
            packed = [coder.encode(x) if x else b"" for x in batch.column(text).to_pylist()]
            more = {ids: list_array(packed, pa.int32())}
            if decoded:
                more[decoded] = decode_lists(more[ids], path)
            yield with_columns(batch, drop, more)

    return map_batches(docs, run, schema)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes of its ids in ``out`` (binary; a null list gives none).

    An id that the rank file lacks is an error.  Columns named ``out`` are replaced.
    """
    schema = replaced_schema(tokens, [out], T.StructField(out, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, ids, 4 << 20):
            yield with_columns(batch, [out], {out: decode_lists(batch.column(ids), path)})

    return map_batches(tokens, run, schema)
