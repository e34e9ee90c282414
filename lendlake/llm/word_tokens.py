"""Token ids of a ``tokenizers`` vocabulary whose words end at white space.

The vocabulary drops white space before it merges, and its normaliser (NFC,
lower case) never reaches across a blank or line feed.  A text therefore has
the ids of its blank-separated chunks in a row.  A chunk of letters with
punctuation after them has the ids of its letters, which are one word, and of
its punctuation.  Each distinct word goes through the library once per worker
and memo filling, many words joined by blanks in a call; a word's last id ends
in the vocabulary's end-of-word mark, so the ids fall apart again.
"""

from __future__ import annotations

import gc
import os
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, map_batches, replaced_schema, with_column

MEMO_ENTRIES = 900_000
MEMO_LENGTH = 64
PUNCTUATION = ".,;:!?#*$%&|"  # not the apostrophe: the vocabulary has pieces like 's


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text when they stand in a document.
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _one_by_one(self, chunks: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        for chunk, x in zip(chunks, found):
            self.known[chunk] = array("I", x.ids).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words of letters, several hundred in a call."""
        parts = [words[i : i + 512] for i in range(0, len(words), 512)]
        joined = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, found in zip(parts, joined):
            ids = np.array(found.ids, np.uint32)
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:  # letters that the normaliser turns into more than one word
                self._one_by_one(part)

    def _learn(self, chunks: set[str]) -> None:
        words = [c for c in chunks if c.isalpha()]
        others = [c for c in chunks if not c.isalpha()]
        stems = [c.rstrip(PUNCTUATION) for c in others]
        new = {s for s in stems if s.isalpha()}.difference(self.known).difference(words)
        self._learn_words(words + list(new))
        marks = {c[len(s) :] for c, s in zip(others, stems)}.difference(self.known)
        self._one_by_one(list(marks))
        odd = []
        for chunk, stem in zip(others, stems):
            # One word only: a letter whose lower case holds a mark would run into the punctuation.
            if stem.isalpha() and (stem.isascii() or stem.lower().isalpha()):
                self.known[chunk] = self.known[stem] + self.known[chunk[len(stem) :]]
            else:
                odd.append(chunk)
        self._one_by_one(odd)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian uint32."""
        split = [_lowered(text).replace("\n", " ").split(" ") for text in texts]
        distinct = set().union(*split)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > MEMO_ENTRIES:
            self.known.clear()
            new = distinct
        self._learn(new)
        ids = self.known.__getitem__
        out = [b"".join(map(ids, chunks)) for chunks in split]
        for chunk in [c for c in new if len(c) > MEMO_LENGTH]:
            del self.known[chunk]
        return out


def _lowered(text: str) -> str:
    """Lower case, where that is sure to be what the normaliser does (after NFC, sign by sign)."""
    if text.isascii() or not ("\u03a3" in text or "\u0130" in text) and unicodedata.is_normalized("NFC", text):
        return text.lower()
    return text


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of a worker process, built once."""
    coder = WordEncoder(path)
    gc.freeze()
    return coder


def encode(docs: DataFrame, path: str, end_id: int, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with its whole texts replaced by their ids and one ``end_id``.

    ``ids`` is binary: little-endian unsigned 32-bit integers.  Null and empty
    texts give the end id alone.  The text column goes, a column named like
    ``ids`` is replaced, all others pass unchanged; rows are independent.
    """
    drop = [text, ids]
    schema = replaced_schema(docs, drop, T.StructField(ids, T.BinaryType()))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in by_bytes(batches, text, 4 << 20):
            packed = coder.encode([x or "" for x in batch.column(text).to_pylist()])
            yield with_column(batch, drop, ids, pa.array([x + end for x in packed], pa.binary()))

    return map_batches(docs, run, schema)
