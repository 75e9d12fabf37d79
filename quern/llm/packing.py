"""Best-fit packing of token sequences, bulk-synchronous.

Documents become pieces of token ids (longer ones are cut, the first piece may be shorter) and pieces
fill sequences of at most `limit` tokens. Pieces of one length are interchangeable, and so are gaps of one
width, so what is sorted and swept are runs: a length with a range of ranks, a width with a range of
sequences. A superstep, all in the engine:

1. Range-sort. Runs of pieces and of gaps are put into one descending order, gaps before pieces of
   their size. Pieces larger than every gap get new sequences, no more than they need at least.
2. Successor sweep. The sum of gaps less pieces along the order says for every run how many pieces find
   a gap (a piece takes the narrowest one that is still free and holds it, the largest pieces first) and how
   many gaps stay free: sums and minima over the order, no loop over lengths.
3. Conflicts by rank. Pieces that matched and gaps that were taken meet rank by rank; ranges of ranks cut one
   another into ranges of pairs. Where a length has more pieces than gaps, a pair takes several of them,
   as many as fit and are there for all.
4. Gaps are updated to what is left of them, the ranks that remain go on, and the next superstep follows.

The driver runs the loop and sees one row of sums a superstep; 10 to 30 are needed, the outcome is within a
tenth of a per cent of best-fit decreasing piece by piece. The runs are bounded by `limit`, whatever the
size of the corpus. What grows with the data are tokens, counts and ranks: each length is cut into salted
parts of about PART_ROWS pieces, by its count, so that no length lands in one task, and a part meets only the
ranges that overlap its own.

Null texts count as empty: one piece, the end token. Repeated rows are packed as often as they occur; a null
id stays null; texts of any length are cut whole. An empty table gives no rows. Columns of df other than key
and text are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import scratch, ship, trim, written

#: Pieces of a part of a length.
PART_ROWS = 1_000
#: Words kept in a worker, and the longest of them (characters).
CACHE_ENTRIES, LONGEST_CACHED = 200_000, 64

_encoders: dict[str, PieceEncoder] = {}


class Words(dict):
    """Ids of words after a space; what is missing is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class PieceEncoder:
    """Token ids by the tokenizers library as little-endian 32-bit numbers, with a bounded cache of words.

    In byte-level BPE without a normaliser a space before anything but white space begins a new
    pre-token. Texts of plain Latin characters in which every space is such a one are cut there. Words
    that the cache lacks are encoded by tiktoken over the file's own vocabulary, which gives the same ids
    where ids are in the order of merges (checked); any other text goes to the library whole.
    """

    def __init__(self, path: str):
        import json

        self.path, self.tokenizer = path, None
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.words = self._merger(config["model"]) if plain and not any(config.get(x) for x in ("normalizer", "truncation", "padding")) else None
        self.added = [t["content"] for t in config.get("added_tokens", ())]
        self.foreign = re.compile(r"[^\t\n\r -~¡-ɏ]").search
        self.known = Words(self.words) if self.words else None
        del config
        trim()

    @staticmethod
    def _merger(model: dict):
        """What gives the ids of a word by the vocabulary of a byte-level BPE; None if ids and merges are ordered differently."""
        import tiktoken

        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        base = sorted(vocab[c] for c in byte_of)
        if model.get("dropout") or model.get("ignore_merges") or base != list(range(256)) or [vocab["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
        # a fixed value: the pattern of byte-level BPE
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _library(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_file(self.path)
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        """Whether a text may be cut at its spaces."""
        spaced = "  " in text or " \n" in text or " \t" in text or " \r" in text or text.endswith(" ")
        return self.words is not None and not spaced and not self.foreign(text) and not any(t in text for t in self.added)

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if not self._plain(t)]
        library = dict(zip(whole, self._library([texts[i] for i in whole]))) if whole else {}
        out = []
        for i, text in enumerate(texts):
            if i in library:
                out.append(library[i])
            else:
                head, *words = text.split(" ")  # no space before the first
                out.append(array("I", self.words(head)).tobytes() + b"".join(map(self.known.__getitem__, words)))
        return out


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def cut(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `total` tokens."""
    if total <= limit:
        return [(0, total)]
    first = total % limit or limit
    return [(0, first), *((s, limit) for s in range(first, total, limit))]


def pieces(df: DataFrame, key: str, text: str, path: str, end_id: int, limit: int) -> DataFrame:
    """id, piece, start, length, ids_crc32 and ids (little-endian 32-bit) of every document's pieces."""
    ship(df.sparkSession)
    id_type = df.schema[key].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                rows = []
                for k, ids in zip(part["id"], encode([t or "" for t in part["text"]])):
                    ids += end
                    for n, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((k, n, start, length, zlib.crc32(own), own))
                yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"]).astype({"id": part["id"].dtype})
        trim()

    schema = T.StructType([T.StructField("id", id_type), *T._parse_datatype_string("piece int, start long, length long, ids_crc32 long, ids binary").fields])
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInPandas(run, schema)


#: A run or a placement: n gaps of a width from sequence `first` on, n pieces of a length from rank `first` on, or n sequences
#: from `first` on that take `per` pieces of a length each at offset `at`, from rank `lo` on.
SWEPT = "kind int, size long, first long, n long, at long, per long, lo long"
GAP, PIECE, PLACED = 0, 1, 2


def sweep(state: DataFrame, limit: int) -> DataFrame:
    """A superstep over runs (kind, size, first, n): rows of SWEPT, the runs that remain and what was placed."""
    order = Window.partitionBy().orderBy(F.desc("size"), "kind", "first")
    upto, onward = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    lag = lambda c: F.coalesce(F.lag(c).over(order), F.lit(0))
    is_gap = F.col("kind") == GAP
    swept = state.withColumn("free", F.sum(F.when(is_gap, F.col("n")).otherwise(-F.col("n"))).over(upto))
    swept = swept.withColumn("debt", F.least(F.lit(0), F.min("free").over(upto))).withColumn("depth", F.col("free") - F.col("debt"))
    swept = swept.withColumns({"before": lag("depth"), "debt_before": lag("debt"), "lowest": F.min("depth").over(onward)})
    left = F.when(is_gap, F.greatest(F.lit(0), F.col("lowest") - F.col("before"))).otherwise(F.col("debt_before") - F.col("debt"))
    swept = swept.withColumn("met", F.col("n") - left)
    ranked = swept.withColumn("rank", F.sum("met").over(Window.partitionBy("kind").orderBy(F.desc("size"), "first").rowsBetween(Window.unboundedPreceding, 0)) - F.col("met"))

    # ranges of ranks of pieces and of gaps cut one another
    run = F.struct("size", "first", "n", "met", "rank")
    points = ranked.where("met > 0").groupBy("rank").agg(F.max(F.when(is_gap, run)).alias("gap"), F.max(F.when(~is_gap, run)).alias("piece"), F.max(F.col("rank") + F.col("met")).alias("end"))
    along = Window.partitionBy().orderBy("rank")
    last = lambda c: F.last(c, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(c)
    pairs = points.select("rank", last("gap"), last("piece"), F.coalesce(F.lead("rank").over(along), F.max("end").over(Window.partitionBy())).alias("end"))
    spare = F.floor((F.col("piece.n") - F.col("piece.met")) / F.col("piece.met"))
    pairs = pairs.select(
        F.col("piece.size").alias("length"), F.col("piece.first").alias("lo"), F.col("gap.size").alias("width"), "rank", (F.col("end") - F.col("rank")).alias("many"),
        (F.col("gap.first") + F.col("rank") - F.col("gap.rank")).alias("sequence"), (1 + F.least(spare, F.floor(F.col("gap.size") / F.col("piece.size")) - 1)).alias("per"),
    )
    used = F.sum(F.col("many") * F.col("per")).over(Window.partitionBy("length").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    pairs = pairs.withColumn("from", F.col("lo") + used - F.col("many") * F.col("per"))
    row = lambda kind, size, first, n, at=F.lit(0), per=F.lit(0), lo=F.lit(0): F.struct(*[c.cast(t).alias(k) for k, c, t in (("kind", F.lit(kind), "int"), ("size", size, "long"), ("first", first, "long"), ("n", n, "long"), ("at", at, "long"), ("per", per, "long"), ("lo", lo, "long"))])
    p = {c: F.col(c) for c in ("length", "width", "many", "sequence", "per", "from")}
    made = F.array(row(PLACED, p["length"], p["sequence"], p["many"], limit - p["width"], p["per"], p["from"]), row(GAP, p["width"] - p["per"] * p["length"], p["sequence"], p["many"]))
    taken = pairs.groupBy(F.col("length").alias("size")).agg(F.sum(F.col("many") * F.col("per")).alias("taken"))
    pieces_left = ranked.where(~is_gap).join(taken, "size", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    rest = [
        pairs.select(F.explode(made).alias("row")),
        ranked.where(is_gap).select(row(GAP, F.col("size"), F.col("first") + F.col("met"), F.col("n") - F.col("met")).alias("row")),
        pieces_left.select(row(PIECE, F.col("size"), F.col("first") + F.col("taken"), F.col("n") - F.col("taken")).alias("row")),
    ]
    return rest[0].unionByName(rest[1]).unionByName(rest[2]).select("row.*").where("n > 0 AND size > 0")


def plan(counts: DataFrame, limit: int) -> DataFrame:
    """Ranges of ranks (length, lo, hi) with the sequences that take them, for the number n of pieces by length.

    The piece of rank r goes to sequence `first + (r - lo) div per`, at offset `at + ((r - lo) mod per) x length`.
    """
    spark, made, paths = counts.sparkSession, 0, []
    state = counts.select(F.lit(PIECE).alias("kind"), F.col("length").cast("long").alias("size"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long").alias("n"))
    while True:
        widest = F.coalesce(F.max(F.when(F.col("kind") == GAP, F.col("size"))).over(Window.partitionBy()), F.lit(0))
        large = F.col("size") > F.col("widest")
        facts = state.withColumn("widest", widest).where(F.col("kind") == PIECE).agg(
            F.sum("n").alias("left"), F.sum(F.when(large, F.col("size") * F.col("n"))).alias("tokens"), F.sum(F.when(large & (F.col("size") * 2 > limit), F.col("n"))).alias("alone"),
        ).first()
        if not facts["left"]:
            break
        # pieces of more than half a sequence need one each; without such, all need as many as their tokens fill
        new = facts["alone"] or -(-(facts["tokens"] or 0) // limit)
        opened = spark.range(1 if new else 0).select(*[F.lit(v).cast(t).alias(c) for c, v, t in (("kind", GAP, "int"), ("size", limit, "long"), ("first", made, "long"), ("n", new, "long"))])
        made += new
        paths.append(scratch(spark, "sweep"))
        sweep(state.unionByName(opened), limit).coalesce(1).write.parquet(paths[-1])
        state = spark.read.schema(SWEPT).parquet(paths[-1]).where(F.col("kind") != PLACED).select("kind", "size", "first", "n")
    placed = spark.read.schema(SWEPT).parquet(*paths) if paths else spark.createDataFrame([], SWEPT)
    return placed.where(F.col("kind") == PLACED).select(F.col("size").alias("length"), "lo", (F.col("lo") + F.col("n") * F.col("per")).alias("hi"), "first", "at", "per")


def pack(df: DataFrame, key: str, text: str, path: str, end_id: int, limit: int = 1024) -> DataFrame:
    """The pieces of all documents with sequence_id and offset: key, piece, start, length, ids_crc32, ids, sequence_id, offset.

    `path` is a tokenizers file at the same place on every worker; end_id follows every document's ids.
    """
    cut_up = written(pieces(df, key, text, path, end_id, limit), "pieces")
    counts = written(cut_up.groupBy("length").agg(F.count("*").alias("n")), "counts")  # `limit` rows at most
    ranges = plan(counts, limit)
    salts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    salted = cut_up.join(F.broadcast(counts.select("length", salts.alias("salts"))), "length").withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    parts = written(parts.select("length", "salt", "n", before.alias("before")), "parts")
    met = parts.join(ranges, "length").where((F.col("lo") < F.col("before") + F.col("n")) & (F.col("hi") > F.col("before"))).drop("n")
    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32", "start")
    placed = salted.withColumn("nth", F.row_number().over(order) - 1).join(met.hint("merge"), ["length", "salt"])
    nth = F.col("before") + F.col("nth") - F.col("lo")
    inside = placed.where((nth >= 0) & (nth < F.col("hi") - F.col("lo")))
    return inside.select(
        F.col("id").alias(key), "piece", "start", "length", "ids_crc32", "ids",
        (F.col("first") + F.floor(nth / F.col("per"))).alias("sequence_id"), (F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")).alias("offset"),
    )
