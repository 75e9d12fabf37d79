"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi search.

The automaton reads the text once; at each position its output links name every piece that ends there,
and each relaxes the best score of the position. The path with the highest sum of piece scores wins; a
character that is no piece costs an unknown edge and is written as its bytes. Ties go to the longer piece.

A model whose pieces hold the space mark only at their start cuts at spaces, so the search runs for
each pre-token, and a bounded cache of the worker keeps recent ones. A text without spaces is searched whole.

Null texts count as empty and have no ids. Repeated rows are encoded each, an empty table stays empty, columns other than key and
text are not read by `encode`; `decode` keeps all columns and replaces one named like its result. A very long text is
one row of the batch: memory grows with it, about 30 bytes a character. Decoding gives the text back (a space mark in the text itself
comes back as a space).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import token_count
from .shared import ship

SPACE = "▁"
#: Added to the least score of a piece for an unknown character.
UNKNOWN_PENALTY = -10.0
#: Pre-tokens kept in a worker, and the longest of them (characters).
CACHE_ENTRIES, LONGEST_CACHED = 300_000, 64

_codecs: dict[str, Codec] = {}


class Words(dict):
    """Ids of pre-tokens as native 32-bit numbers; what is missing is searched."""

    def __init__(self, search):
        super().__init__()
        self.search = search

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.search(SPACE + word.replace(" ", SPACE))[0]).tobytes()
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encodes and decodes with the pieces and scores of a SentencePiece model."""

    def __init__(self, path: str):
        import ahocorasick

        sp = token_count.model(path)
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(self.text[i][1:-1], 16): i for i in range(len(self.text)) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = sp.unk_id()
        plain = [i for i in range(len(self.text)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.silent = {i for i in range(len(self.text)) if sp.is_control(i)}
        self.penalty = min(sp.get_score(i) for i in plain) + UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.text[i], (len(self.text[i]), sp.get_score(i), i))
        self.automaton.make_automaton()
        self.single = {self.text[i] for i in plain if len(self.text[i]) == 1}
        self.known = Words(self.search)
        # by id: its part of a score (the first byte of a character carries the penalty), and whether it is no plain piece
        self.scores = np.zeros(len(self.text))
        self.scores[plain] = [sp.get_score(i) for i in plain]
        self.scores[[i for b, i in self.bytes.items() if b < 0x80 or b >= 0xC0] or [self.unknown]] = self.penalty
        self.special = np.ones(len(self.text), bool)
        self.special[plain] = False

    def search(self, s: str) -> tuple[list[int], float]:
        """Ids of the best path through s, and its score."""
        n, least = len(s), float("-inf")
        if self.single.issuperset(s):  # no unknown edges
            best, back = [0.0, *[least] * n], [None] * (n + 1)
            for end, match in self.automaton.iter(s):
                value = best[end + 1 - match[0]] + match[1]
                if value > best[end + 1]:
                    best[end + 1], back[end + 1] = value, match
            ids, at = [], n
            while at:
                ids.append(back[at][2])
                at -= back[at][0]
            ids.reverse()
            return ids, best[n]
        best, piece, came = [0.0, *[least] * n], [-1] * (n + 1), [0] * (n + 1)
        odd = [i + 1 for i, c in enumerate(s) if c not in self.single]  # ends of unknown edges
        odd.append(n + 1)
        nxt = 0
        for end, (length, score, i) in self.automaton.iter(s):
            end += 1
            while odd[nxt] < end:  # no match ends later than these any more
                o = odd[nxt]
                nxt += 1
                if best[o - 1] + self.penalty > best[o]:
                    best[o], piece[o], came[o] = best[o - 1] + self.penalty, -1, o - 1
            start = end - length
            value = best[start] + score
            if value > best[end]:
                best[end], piece[end], came[end] = value, i, start
        while odd[nxt] <= n:
            o = odd[nxt]
            nxt += 1
            if best[o - 1] + self.penalty > best[o]:
                best[o], piece[o], came[o] = best[o - 1] + self.penalty, -1, o - 1
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(s[came[at] : at].encode("utf-8", "surrogatepass")))
            else:
                ids.append(self.unknown)
            at = came[at]
        return ids[::-1], best[n]

    def encode(self, text: str) -> bytes:
        """Ids as native 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, token_count.pretokens(text)))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; control pieces are silent."""
        if not self.special[ids].any():
            out = "".join(map(self.text.__getitem__, ids.tolist()))
        else:
            raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else self.text[i].encode("utf-8") for i in ids.tolist()]
            out = b"".join(raw).decode("utf-8", "replace")
        return out.replace(SPACE, " ").removeprefix(" ")


def codec(path: str) -> Codec:
    if path not in _codecs:
        token_count.check_model(path)
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """key, text, ids (array of int) and score of every row. `path`: the model file, at the same place on every worker."""
    ship(df.sparkSession)
    fields = [T.StructField("key", df.schema[key].dataType), *T._parse_datatype_string("text string, ids array<int>, score double").fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [own.encode(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(i) // 4 for i in found)])
                flat = np.frombuffer(b"".join(found), np.int32)
                sums = np.concatenate([[0.0], np.cumsum(own.scores[flat])])  # whole numbers in most models; else exact to rounding
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, pa.array(sums[ends[1:]] - sums[ends[:-1]])], names=["key", "text", "ids", "score"])

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, T.StructType(fields))
    return out.select(F.col("key").alias(key), F.col("text").alias(text), "ids", "score")


def decode(df: DataFrame, ids: str, path: str, out: str = "decoded") -> DataFrame:
    """df with the column `out`: the text of the column ids (null stays null)."""

    ship(df.sparkSession)

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = codec(path).decode
        for batch in batches:
            flat, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            yield pa.array([one(flat[a:b]) if has.as_py() else None for a, b, has in zip(ends, ends[1:], batch.is_valid())], pa.string())

    return df.withColumn(out, decoded(F.col(ids)))
