"""Alignment of two tokenizers over the same texts, by id-striped dense count matrices.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads a space and the text; B is a SentencePiece
model and reads the text, to which it adds the space. Both give back the same bytes, so token ends are byte
offsets in one string. Offsets where tokens of both end cut the text into groups, and every token of A is linked with every
token of B whose bytes overlap its own: one link for each stretch between neighbouring ends.

1. Documents are encoded and linked once. A task gathers documents to chunks of about CHUNK_LINKS distinct links
   (document, a, b; with the times it occurs) and writes them as packed arrays, a row per chunk and stripe, where a stripe
   is STRIPE consecutive ids of A. The pairs of a chunk are counted there already.
2. Pairs are partitioned by stripe. A task holds one dense block at a time, STRIPE x (ids of B) counts of documents,
   and adds the chunks' counts to it (np.add.at). Stripes with many chunks are dealt to parts first, whose blocks
   are added up in a second step.
3. Links meet the counts of their stripe in the same partition, counts first: the block is filled, its row maxima are
   the best counts of the ids of A, and the links behind are scored one row at a time. Stripes with many links
   are dealt to parts, each of which gets the counts. Sums go back to the documents by chunk.

Nothing is collected but the numbers of chunks and links by stripe. Memory of a task is a block and a chunk;
one document's links are held together, whatever its length.

Null and empty texts, and texts whose tokens of either side do not give back a space and the text (such as those with a
space mark U+2581), have no tokens: zeros, and an empty digest. Special strings are plain text. Repeated rows count
each. Texts of any length are aligned whole. An empty table gives no rows; columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import packing, token_count
from .shared import ship, trim, written

#: Ids of A of a stripe.
STRIPE = 256
#: Distinct links and documents of a chunk, and characters encoded together.
CHUNK_LINKS, CHUNK_DOCS, CHARS = 1 << 20, 1 << 15, 1 << 20
#: Rows of chunks whose counts one task adds up, and links that one task scores.
PART_CHUNKS, PART_LINKS = 1 << 11, 1 << 19
#: Pre-tokens kept in a worker, and the longest of them (characters).
CACHE_ENTRIES, LONGEST_CACHED = 200_000, 64

_aligners: dict[tuple[str, str], Aligner] = {}


class PlainEncoder(packing.PieceEncoder):
    """Ids of A; special strings in a text are text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.added = []

    def _library(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            super()._library([])
            self.tokenizer.encode_special_tokens = True
        return super()._library(texts)


class Pieces(dict):
    """Ids of B by pre-token; what is missing is asked of the library."""

    def __init__(self, model):
        super().__init__()
        self.encode, self.space = model.encode, model.piece_to_id("▁")

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word) if word else [self.space]).tobytes()
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


def bytes_of_a(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file; those of added tokens are their text's."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    # fixed values: the characters that byte-level BPE writes for bytes
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    added = {t["id"]: t["content"].encode() for t in config.get("added_tokens", ())}
    vocab = config["model"]["vocab"]
    out = [b""] * (max([*vocab.values(), *added]) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte_of[c] for c in token) if i not in added else b""
    for i, raw in added.items():
        out[i] = raw
    return out


def bytes_of_b(path: str) -> list[bytes]:
    """The bytes of every piece of a SentencePiece model."""
    sp = token_count.model(path)
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    return [piece(i) for i in range(sp.get_piece_size())]


class Aligner:
    """Encodes texts by both sides and links their tokens."""

    def __init__(self, path_a: str, path_b: str):
        token_count.check_model(path_b)
        self.encode_a, self.pieces = PlainEncoder(path_a).encode, Pieces(token_count.model(path_b))
        self.raw = bytes_of_a(path_a), bytes_of_b(path_b)
        self.sizes = tuple(np.array([len(x) for x in raw], np.int64) for raw in self.raw)
        # decimal ids with what follows them: within a side, at its end
        self.shown = tuple(np.array([[b"%d," % i for i in range(len(raw))], [b"%d%c" % (i, end) for i in range(len(raw))]], object) for raw, end in zip(self.raw, b"|;"))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; empty arrays for texts that do not come back."""
        a = [np.frombuffer(x, np.uint32) for x in self.encode_a([" " + t for t in texts])]
        b = [np.frombuffer(b"".join(map(self.pieces.__getitem__, token_count.pretokens(t))), np.uint32) for t in texts]
        none = np.empty(0, np.uint32)
        for i, t in enumerate(texts):
            whole = (" " + t).encode()
            if not t or any(b"".join(map(raw.__getitem__, ids[i].tolist())) != whole for raw, ids in zip(self.raw, (a, b))):
                a[i] = b[i] = none
        return a, b

    def link(self, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers (n_a, n_b, n_groups, n_links) and digests by text, and all links as (text, a, b)."""
        a, b = self.encode(texts)
        n = len(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        a, b = (np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int64) for ids in (a, b))
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at_b, at_a = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)  # the token of the other side that ends there or later
        both_a, both_b = end_b[at_b] == end_a, end_a[at_a] == end_b
        only = ~both_b
        links = np.concatenate([doc_a, doc_b[only]]), np.concatenate([a, a[at_a[only]]]), np.concatenate([b[at_b], b[only]])
        numbers = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc_a[both_a], minlength=n), "n_links": np.bincount(links[0], minlength=n)}
        # groups in turn: ids of A, then those of B
        first_a, first_b = (np.concatenate([[0], np.flatnonzero(both) + 1]) for both in (both_a, both_b))
        group_a, group_b = (np.cumsum(both) - both for both in (both_a, both_b))
        shown = np.empty(len(a) + len(b), object)
        shown[np.arange(len(a)) + first_b[group_a]] = self.shown[0][both_a.astype(int), a]
        shown[np.arange(len(b)) + first_a[group_b + 1]] = self.shown[1][both_b.astype(int), b]
        ends = np.cumsum(n_a + n_b).tolist()
        digests = [hashlib.sha256(b"".join(shown[i:j].tolist())[:-1]).hexdigest() if j > i else "" for i, j in zip([0, *ends], ends)]
        return numbers, digests, links


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
        trim()
    return _aligners[path_a, path_b]


class Packer:
    """The links of a chunk as sorted numbers (stripe, document, id in the stripe, id of B), packed by stripe."""

    def __init__(self, ids_b: int):
        self.ids_b, self.keys, self.docs, self.links = ids_b, [], 0, 0

    def add(self, docs: int, links: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        doc, a, b = links
        self.keys.append((((a // STRIPE) * (2 * CHUNK_DOCS) + self.docs + doc) * STRIPE + a % STRIPE) * self.ids_b + b)
        self.docs, self.links = self.docs + docs, self.links + len(doc)

    def rows(self, chunk: int) -> Iterator[pa.RecordBatch]:
        keys = np.sort(np.concatenate(self.keys)) if self.keys else np.empty(0, np.int64)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times, keys = np.diff(first, append=len(keys)).astype(np.uint32), keys[first]
        cells, place = keys % (STRIPE * self.ids_b), keys // (STRIPE * self.ids_b)
        docs, stripes = (place % (2 * CHUNK_DOCS)).astype(np.uint32), place // (2 * CHUNK_DOCS)
        bounds = np.flatnonzero(np.diff(stripes, prepend=-1)).tolist()
        for i, j in zip(bounds, [*bounds[1:], len(keys)]):
            pairs, held = np.unique(cells[i:j], return_counts=True)
            packed = [docs[i:j], cells[i:j].astype(np.uint32), times[i:j], pairs.astype(np.uint32), held.astype(np.uint32)]
            yield {"chunk": chunk, "stripe": int(stripes[i]), "links": j - i} | dict(zip(("docs", "cells", "times", "pairs", "held"), (x.tobytes() for x in packed)))
        self.keys, self.docs, self.links = [], 0, 0


DOC_FIELDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
LINK_FIELDS = "stripe int, links long, docs binary, cells binary, times binary, pairs binary, held binary"


def linked(df: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (stripe is null) with their chunk and place in it, and rows of packed links by chunk and stripe; written."""
    fields = [T.StructField("chunk", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("id", df.schema[key].dataType), *T._parse_datatype_string(f"{DOC_FIELDS}, {LINK_FIELDS}").fields]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        own, arrow = aligner(path_a, path_b), to_arrow_schema(schema)
        chunk, packer = TaskContext.get().partitionId() << 32, Packer(len(bytes_of_b(path_b)))

        def made(columns: dict, rows: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in arrow], schema=arrow)

        def flushed() -> Iterator[pa.RecordBatch]:
            for row in packer.rows(chunk):
                yield made({k: [v] for k, v in row.items()}, 1)

        for batch in batches:
            texts, at = [t or "" for t in batch.column(1).to_pylist()], 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= CHARS):
                    chars += len(texts[upto])
                    upto += 1
                numbers, digests, links = own.link(texts[at:upto])
                docs = upto - at
                places = np.arange(packer.docs, packer.docs + docs, dtype=np.int32)
                yield made({"chunk": [chunk] * docs, "place": places, "id": batch.column(0).slice(at, docs), "groups_sha256": digests} | numbers, docs)
                packer.add(docs, links)
                at = upto
                if packer.links >= CHUNK_LINKS or packer.docs >= CHUNK_DOCS:
                    yield from flushed()
                    chunk += 1
        yield from flushed()
        trim()

    return written(df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema), "links")


def _added(batches: Iterator[pa.RecordBatch], ids_b: int) -> Iterator[pa.RecordBatch]:
    """Sums of the counts of each stripe and part, which come in order; one dense block is held at a time."""
    block, own = np.zeros(STRIPE * ids_b, np.int64), None

    def done() -> pa.RecordBatch:
        cells = np.flatnonzero(block)
        arrays = [pa.array([own], pa.int32()), pa.array([cells.astype(np.uint32).tobytes()]), pa.array([block[cells].tobytes()])]
        block[cells] = 0
        return pa.RecordBatch.from_arrays(arrays, names=["stripe", "cells", "n"])

    for batch in batches:
        for stripe, part, cells, n in zip(*(batch.column(c).to_pylist() for c in ("stripe", "part", "cells", "n"))):
            if own is not None and (stripe, part) != last:
                yield done()
            own, last = stripe, (stripe, part)
            np.add.at(block, np.frombuffer(cells, np.uint32), np.frombuffer(n, np.uint32 if len(n) == len(cells) else np.int64))
    if own is not None:
        yield done()


def pair_counts(links: DataFrame, parts: DataFrame, ids_b: int) -> DataFrame:
    """The number of documents of every linked pair: stripe, cells (id in the stripe x ids of B + id of B) and n, packed; one row a stripe, written."""
    rows = links.where("stripe IS NOT NULL").select("stripe", "chunk", F.col("pairs").alias("cells"), F.col("held").alias("n"))
    rows = rows.join(F.broadcast(parts.select("stripe", "counters")), "stripe").withColumn("part", F.pmod(F.xxhash64("chunk"), F.col("counters")).cast("int"))

    def step(df: DataFrame) -> DataFrame:
        dealt = df.select("stripe", "part", "cells", "n").repartition("stripe", "part").sortWithinPartitions("stripe", "part")
        return dealt.mapInArrow(lambda x: _added(x, ids_b), "stripe int, cells binary, n binary")

    return written(step(step(rows).withColumn("part", F.lit(0))), "pair_counts")


def best_pairs(counts: DataFrame, ids_b: int) -> DataFrame:
    """a, b and n of the pairs whose count is the highest of their id a, ties included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stripe, cells, n in zip(*(batch.column(c).to_pylist() for c in ("stripe", "cells", "n"))):
                cells, n = np.frombuffer(cells, np.uint32).astype(np.int64), np.frombuffer(n, np.int64)
                best = np.zeros(STRIPE, np.int64)
                np.maximum.at(best, cells // ids_b, n)
                top = n == best[cells // ids_b]
                yield pa.RecordBatch.from_arrays([pa.array(stripe * STRIPE + cells[top] // ids_b), pa.array(cells[top] % ids_b), pa.array(n[top])], names=["a", "b", "n"])

    return counts.select("stripe", "cells", "n").mapInArrow(run, "a long, b long, n long")


def _scored(batches: Iterator[pa.RecordBatch], ids_b: int) -> Iterator[pa.RecordBatch]:
    """Sums by document of every row of links; the counts of its stripe come before it."""
    block, best, filled = np.zeros(STRIPE * ids_b, np.int64), None, np.empty(0, np.uint32)
    for batch in batches:
        out = []
        for kind, chunk, docs, cells, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "chunk", "docs", "cells", "n"))):
            cells = np.frombuffer(cells, np.uint32)
            if kind == 0:
                block[filled] = 0
                block[cells], filled = np.frombuffer(n, np.int64), cells
                best = block.reshape(STRIPE, ids_b).max(axis=1)
                continue
            docs, times, count = np.frombuffer(docs, np.uint32), np.frombuffer(n, np.uint32).astype(np.int64), block[cells]
            first = np.flatnonzero(np.diff(docs.astype(np.int64), prepend=-1))
            sums = [np.add.reduceat(x, first) for x in (np.where(count == best[cells // ids_b], times, 0), count * times)]
            out.append((chunk, docs[first].tobytes(), *(x.tobytes() for x in sums)))
        chunks, *packed = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)], names=["chunk", "docs", "n_best", "count_sum"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each chunk's documents over its stripes, which come together."""
    own, best, total = None, np.zeros(2 * CHUNK_DOCS, np.int64), np.zeros(2 * CHUNK_DOCS, np.int64)

    def done() -> pa.RecordBatch:
        places = np.flatnonzero(total)
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(places), own, np.int64)), pa.array(places.astype(np.int32)), pa.array(best[places]), pa.array(total[places])], names=["chunk", "place", "n_best", "count_sum"])
        best[:], total[:] = 0, 0
        return out

    for batch in batches:
        for chunk, docs, n_best, count_sum in zip(*(batch.column(c).to_pylist() for c in ("chunk", "docs", "n_best", "count_sum"))):
            if own is not None and chunk != own:
                yield done()
            own, docs = chunk, np.frombuffer(docs, np.uint32)
            best[docs] += np.frombuffer(n_best, np.int64)  # a document is there once a row
            total[docs] += np.frombuffer(count_sum, np.int64)
    if own is not None:
        yield done()


def scores(links: DataFrame, counts: DataFrame, parts: DataFrame, ids_b: int) -> DataFrame:
    """chunk, place, n_best and count_sum of every document that has links."""
    null = lambda t: F.lit(None).cast(t)
    rows = links.where("stripe IS NOT NULL").join(F.broadcast(parts.select("stripe", "scorers")), "stripe")
    rows = rows.select("stripe", F.pmod(F.xxhash64("chunk"), F.col("scorers")).cast("int").alias("part"), F.lit(1).alias("kind"), "chunk", "docs", "cells", F.col("times").alias("n"))
    known = counts.join(F.broadcast(parts.select("stripe", "scorers")), "stripe").withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("scorers") - 1).cast("int"))))
    both = rows.unionByName(known.select("stripe", "part", F.lit(0).alias("kind"), null("long").alias("chunk"), null("binary").alias("docs"), "cells", "n"))
    met = both.repartition("stripe", "part").sortWithinPartitions("stripe", "part", "kind").select("kind", "chunk", "docs", "cells", "n")
    packed = met.mapInArrow(lambda x: _scored(x, ids_b), "chunk long, docs binary, n_best binary, count_sum binary")
    return packed.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, "chunk long, place int, n_best long, count_sum long")


def align(df: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    n_best: its links whose pair is in as many documents as any pair of the same id of A; count_sum: the documents of the
    pairs of all its links. groups_sha256: of `a1,a2|b1;a3|b2`, the ids by group. Paths: files at the same place on every worker.
    """
    ship(df.sparkSession)
    links, ids_b = linked(df, key, text, path_a, path_b), len(bytes_of_b(path_b))
    share = lambda c, n: F.greatest(F.lit(1), F.ceil(c / n)).cast("long")
    of = links.where("stripe IS NOT NULL").groupBy("stripe").agg(F.count("*").alias("chunks"), F.sum("links").alias("links"))
    parts = written(of.select("stripe", share(F.col("chunks"), PART_CHUNKS).alias("counters"), share(F.col("links"), PART_LINKS).alias("scorers")), "parts")  # a row per stripe
    found = scores(links, pair_counts(links, parts, ids_b), parts, ids_b)
    docs = links.where("stripe IS NULL").select("chunk", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return docs.join(found, ["chunk", "place"], "left").select(F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
