"""Token counts by a two-tier lookup on the map side.

A SentencePiece model whose pieces hold the space mark only at their start tokenises every
pre-token (a run of spaces and what follows up to the next space) on its own, so the count of a text
is a sum of lengths. The first tier is a compact broadcast table of the lengths of frequent
pre-tokens; what it lacks is encoded by the library and kept in a bounded cache of the worker.
No pre-token is shuffled, and neither tier changes a result: both only hold what the library says.

Nulls count as empty texts (0 tokens), repeated rows count each, an empty table stays empty. A column named
like the result is replaced, all others pass. A text of one endless pre-token goes to the library whole, which takes
some hundred bytes of memory for each of its own.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

#: Pre-tokens longer than this (characters) are encoded each time, so that the cache stays small.
LONGEST_CACHED = 64
#: Entries of the worker's cache; it starts anew beyond that.
CACHE_ENTRIES = 200_000

_models: dict[str, object] = {}
_caches: dict[str, object] = {}
_SPACED = re.compile(r" *[^ ]+| +")


def model(path: str):
    """The SentencePiece model at path, loaded once per process."""
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def check_model(path: str) -> None:
    """Refuse a model for which pre-tokens are not independent."""
    sp = model(path)
    if any("▁" in p.lstrip("▁") for p in (sp.id_to_piece(i) for i in range(sp.get_piece_size()))):
        raise ValueError("the model has pieces with a space mark after another character")
    for text, marks in (("a  b", 3), ("  ", 3), ("ﬁ", 1)):
        if sum(p.count("▁") for p in sp.encode(text, out_type=str)) != marks or sp.decode(sp.encode(text)) != text:
            raise ValueError("the model must add a leading space, keep all spaces and not normalise")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, without the one space that begins each."""
    parts = text.replace("▁", " ").split(" ")
    if "" not in parts:
        return parts
    if parts == [""]:
        return []
    return [x[1:] for x in _SPACED.findall(" " + " ".join(parts))]


class Lengths(dict):
    """Lengths by pre-token; what is missing is asked of the library."""

    def __init__(self, path: str, known: dict[str, int]):
        super().__init__(known)
        self.encode, self.known = model(path).encode, known

    def __missing__(self, word: str) -> int:
        n = len(self.encode(word)) if word else 1
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES + len(self.known):
                self.clear()
                self.update(self.known)
            self[word] = n
        return n


def pack_table(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """A table as UTF-8 bytes, their lengths (uint16) and token counts (uint16)."""
    raw = [w.encode() for w in lengths]
    return b"".join(raw), np.array([len(r) for r in raw], np.uint16).tobytes(), np.array(list(lengths.values()), np.uint16).tobytes()


def unpack_table(table: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    ends = np.cumsum(np.frombuffer(table[1], np.uint16), dtype=np.int64).tolist()
    return {table[0][a:b].decode(): n for a, b, n in zip([0, *ends], ends, np.frombuffer(table[2], np.uint16).tolist())}


def frequent_table(df: DataFrame, text: str, path: str, entries: int, sample_rows: int) -> Broadcast:
    """The first tier: lengths of the pre-tokens most frequent in about sample_rows texts.

    One job: tasks count their own sampled texts, sums are made in the engine, and `entries` rows come
    back. The broadcast table is bounded by `entries` x LONGEST_CACHED characters. It is a cache warmed on a
    bounded sample: counts of tokens do not depend on it.
    """
    spark, rows = df.sparkSession, df.count()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                seen.update(w for w in pretokens(t) if len(w) <= LONGEST_CACHED)
        yield pd.DataFrame({"word": np.array(list(seen), object), "n": np.array(list(seen.values()), np.int64)})

    drawn = df.select(F.coalesce(F.col(text), F.lit("")).alias("text")).sample(min(1.0, sample_rows / max(rows, 1)), seed=7)
    summed = drawn.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    encode = model(path).encode
    known = {r["word"]: len(encode(r["word"])) if r["word"] else 1 for r in summed.orderBy(F.desc("n"), "word").limit(entries).collect()}
    return spark.sparkContext.broadcast(pack_table({w: n for w, n in known.items() if n < 1 << 16}))


def count_tokens(df: DataFrame, text: str, path: str, out: str = "n_tokens", entries: int = 1 << 15, sample_rows: int = 4096) -> DataFrame:
    """df with the column `out`: the number of tokens of `text` under the SentencePiece model at path.

    `path` must be readable at the same place on every worker (an installed vocabulary file).
    """
    check_model(path)
    ship(df.sparkSession)
    table = frequent_table(df, text, path, entries, sample_rows)
    key = f"{path} {uuid.uuid4().hex}"

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _caches:
            _caches.clear()
            _caches[key] = Lengths(path, unpack_table(table.value))
        length = _caches[key].__getitem__
        for batch in batches:
            yield pd.Series([sum(map(length, pretokens(t))) for t in batch], dtype="int64")

    return df.withColumn(out, counted(F.coalesce(F.col(text), F.lit(""))))
