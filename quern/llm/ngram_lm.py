"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted arrays, memory-mapped by workers.

Counting takes every training text. Workers hash words, sort and count what they read, and shuffle
sorted, delta-coded runs; a bucket's runs are merged and written to the shared folder as arrays:

- words: sorted 64-bit hashes (cut into buckets by their leading bits) with counts; a word's place is its number;
- pairs: sorted keys with counts. With B buckets a pair (v, w) is in bucket (w + hash(v)) mod B under the key
  v << 24 | w div B: bucket and key give the pair back, and frequent contexts and words spread over all buckets;
- by word number: how often it is a context, its back-off weight, and in how many contexts it follows.

Buckets hold a bounded share of the text each, so that tasks do not grow with the corpus, and a chunk of
tokens opens the buckets that it needs only. Scoring maps these files; only chunks of tokens and their sums
are in memory. What comes to the driver is a row per word bucket (WORD_BUCKET_BYTES of text) and two sums.

    p(w | v) = max(c(vw) - D, 0) / c(v) + weight(v) p(w)
    p(w)     = max(t(w) - D', 0) / T + weight' / (V + 1)

t(w) counts the contexts of w, T is their sum; each level has three discounts (for counts 1, 2, 3 and
more) from its counts of counts. V is the number of distinct tokens; unknown words share one place, so
p(. | v) sums to 1. An unknown context leaves p(w).

Null texts are empty: the end token alone. Without training texts p(w) is 1 over the one unknown place.
Repeated rows count and are scored as often as they occur. Columns other than key and text are not read. Words
are told apart by 64-bit hashes: two of n distinct words count as one with probability n^2 / 2^65. More than
2^40 - 2 distinct words are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .near_duplicates import WordHashes, mix, word_list
from .shared import delete, map_array, put_array, scratch, ship, trim

#: Tokens sorted at once in a worker.
CHUNK = 1 << 18
#: Bytes of text per bucket of pairs and of words (which repeat), and pair buckets that a task takes, one after the other.
BUCKET_BYTES, WORD_BUCKET_BYTES, TASK_BUCKETS = 12_000_000, 48_000_000, 2
#: Word numbers per file of the arrays by word number.
RANGE = 1 << 18
#: Bits of a pair's key for the word.
WORD_BITS = np.uint64(24)
RUN = "bucket int, n int, first long, width int, steps binary, kind string, counts binary"


def pack_run(bucket: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
    """Sorted distinct keys and their counts as a row of RUN: the first key, then steps in as few bytes as the largest needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    narrow = next(t for t in ("u1", "u2", "u4", "u8") if int(counts.max(initial=0)) <= np.iinfo(t).max)
    raw = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return bucket, len(keys), int(keys[:1].view(np.int64)[0]), width, raw, narrow, counts.astype(narrow).tobytes()


def unpack_run(n: int, first: int, width: int, steps: bytes, kind: str, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = np.zeros((n, 8), np.uint8)
    wide[1:, :width] = np.frombuffer(steps, np.uint8).reshape(n - 1, width)
    values = wide.view("<u8").reshape(-1)
    values[0] = np.int64(first).view(np.uint64)
    return np.cumsum(values, dtype=np.uint64), np.frombuffer(counts, kind).astype(np.int64)


def merge(runs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of many runs and the sums of their counts."""
    parts = [unpack_run(*r) for r in runs[["n", "first", "width", "steps", "kind", "counts"]].itertuples(index=False)]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """D for counts 0 to 3 (and more). Where counts of counts are missing, a level takes 0.5 from what it has."""
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([min(max(x, 0.0 if not i else 1e-3), float(i)) for i, x in enumerate(d)])


@dataclass
class Model:
    """Where the arrays are, and the numbers that all workers need."""

    root: str
    tokens: int = 0
    texts: int = 0
    word_offsets: list[int] = field(default_factory=lambda: [0])  # by bucket of words, the last is their number
    pair_buckets: int = 1
    discounts2: list[float] = field(default_factory=lambda: [0.0] * 4)
    discounts1: list[float] = field(default_factory=lambda: [0.0] * 4)
    followed: int = 0  # sum of t(w)
    weight1: float = 1.0

    @property
    def words(self) -> int:
        return self.word_offsets[-1]

    @property
    def distinct(self) -> int:
        """Distinct tokens, the end among them."""
        return self.words + (self.texts > 0)

    def find_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1 if unknown) and counts of sorted distinct hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        buckets = len(self.word_offsets) - 1
        edges = np.searchsorted(word_bucket(hashes, buckets), np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = hashes[edges[b] : edges[b + 1]]
            if self.word_offsets[b + 1] > self.word_offsets[b]:
                keys = map_array(self.root, f"words-{b}", "<u8")
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == own)
                number[edges[b] + hit] = self.word_offsets[b] + at[hit]
                count[edges[b] + hit] = map_array(self.root, f"word_counts-{b}", "<i8")[at[hit]]
        return number, count

    def find_pairs(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Counts of pairs of numbers."""
        bucket, keys = pair_place(context, word, self.pair_buckets)
        out, order = np.zeros(len(keys), np.int64), np.lexsort((keys, bucket))
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for i, j in zip(starts, [*starts[1:], len(order)]):
            own = order[i:j]
            b = int(bucket[own[0]])
            stored = map_array(self.root, f"pairs-{b}", "<u8")
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys[own]), len(stored) - 1)
                hit = stored[at] == keys[own]
                raw = map_array(self.root, f"pair_counts-{b}", "u1")  # the width of a count, then the counts
                out[own[hit]] = raw[8:].view(f"<u{raw[0]}")[at[hit]]
        return out

    def by_number(self, name: str, numbers: np.ndarray, dtype: str) -> np.ndarray:
        """Values of sorted word numbers from an array by word number."""
        out = np.zeros(len(numbers), dtype)
        edges = np.searchsorted(numbers, np.arange(0, self.words + 2 + RANGE, RANGE))
        for r in np.flatnonzero(np.diff(edges)).tolist():
            out[edges[r] : edges[r + 1]] = map_array(self.root, f"{name}-{r}", dtype)[numbers[edges[r] : edges[r + 1]] - r * RANGE]
        return out


def word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def pair_place(context: np.ndarray, word: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and key of pairs of numbers."""
    v, w, n = context.astype(np.uint64), word.astype(np.uint64), np.uint64(buckets)
    return ((w + mix(v) % n) % n).astype(np.int64), v << WORD_BITS | w // n


def pair_of(bucket: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a bucket's keys."""
    v, n = keys >> WORD_BITS, np.uint64(buckets)
    low = (np.uint64(bucket) + n - mix(v) % n) % n
    return v.astype(np.int64), ((keys & ((np.uint64(1) << WORD_BITS) - np.uint64(1))) * n + low).astype(np.int64)


def hashed(texts: list, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and the number of words of each."""
    lists = [word_list(t or "") for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    get = hashes.__getitem__
    return np.fromiter((h for x in lists for h in map(get, x)), np.uint64, int(sizes.sum())), sizes


def chunks(batches: Iterator[pd.DataFrame], hashes: WordHashes) -> Iterator[tuple[list[pd.DataFrame], np.ndarray, np.ndarray]]:
    """Batches gathered up to CHUNK words: the batches, their word hashes and words per text."""
    held, words, sizes, n = [], [], [], 0
    for batch in batches:
        w, s = hashed(batch["text"].tolist(), hashes)
        held.append(batch)
        words.append(w)
        sizes.append(s)
        n += len(w)
        if n >= CHUNK:
            yield held, np.concatenate(words), np.concatenate(sizes)
            held, words, sizes, n = [], [], [], 0
    if held:
        yield held, np.concatenate(words), np.concatenate(sizes)
    hashes.clear()
    trim()


def sequences(numbers: np.ndarray, sizes: np.ndarray, end: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (each text's words, then the end), the token before each, and where texts start."""
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    tokens = np.full(len(numbers) + len(sizes), end, np.int64)
    is_end = np.zeros(len(tokens), bool)
    is_end[starts + sizes] = True
    tokens[~is_end] = numbers
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = begin
    return tokens, before, starts


def _runs(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray, buckets: int) -> pd.DataFrame:
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [pack_run(b, keys[order[i:j]], counts[order[i:j]]) for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
    return pd.DataFrame(rows, columns=[x.split(" ")[0] for x in RUN.split(", ")])


def train(docs: DataFrame, text: str) -> Model:
    """Count docs and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = texts.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("texts")).first()
    model = Model(scratch(spark, "ngram_lm"), texts=seen["texts"])
    root = model.root
    if not seen["texts"]:
        return model
    word_buckets = 1 << max(0, int(seen["bytes"] // WORD_BUCKET_BYTES).bit_length())
    buckets = 1 << max(0, int(seen["bytes"] // BUCKET_BYTES).bit_length())

    def dealt(runs: DataFrame, buckets: int, together: int) -> GroupedData:
        """Runs by bucket, `together` neighbouring buckets a task."""
        place = F.floor(F.col("bucket") / together).cast("int")
        return runs.withColumn("place", place).repartitionById(-(-buckets // together), F.col("place")).groupBy("place", "bucket")

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, words, _ in chunks(batches, WordHashes()):
            keys, counts = np.unique(words, return_counts=True)
            if len(keys):
                yield _runs(keys, counts, word_bucket(keys, word_buckets), word_buckets)

    def write_words(runs: pd.DataFrame) -> pd.DataFrame:
        b, (keys, counts) = int(runs["bucket"].iloc[0]), merge(runs)
        put_array(root, f"words-{b}", keys.astype("<u8"))
        put_array(root, f"word_counts-{b}", counts.astype("<i8"))
        return pd.DataFrame({"bucket": [b], "n": [len(keys)], "total": [int(counts.sum())]})

    made = dealt(texts.mapInPandas(count_words, RUN), word_buckets, 1).applyInPandas(write_words, "bucket int, n long, total long").collect()  # a row per word bucket
    sizes = [0] * word_buckets
    for r in made:
        sizes[r["bucket"]] = r["n"]
    model.word_offsets = [0, *np.cumsum(sizes).tolist()]
    model.tokens = sum(r["total"] for r in made) + model.texts
    if model.words >= (1 << 40) - 2:
        raise ValueError("more distinct words than 40-bit numbers hold")
    model.pair_buckets = buckets
    end, begin = model.words, model.words + 1
    sent = spark.sparkContext.broadcast(model)  # offsets only: a number per bucket

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for _, words, sizes in chunks(batches, WordHashes()):
            distinct, inverse = np.unique(words, return_inverse=True)
            tokens, before, _ = sequences(own.find_words(distinct)[0][inverse], sizes, end, begin)
            bucket, keys = pair_place(before, tokens, buckets)
            order = np.lexsort((keys, bucket))
            bucket, keys = bucket[order], keys[order]
            first = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(keys.view(np.int64), prepend=-1) != 0))
            counts = np.diff(first, append=len(keys))
            yield _runs(keys[first], counts, bucket[first], buckets)

    parts = "kind string, part int, salt int, ids binary, total binary, n1 binary, n2 binary, n3 binary, n4 binary"

    salts = 1 << (buckets.bit_length() // 2)  # a word's sums come from all buckets: they are added in two steps

    def by_range(kind: str, salt: int, ids: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
        edges = np.searchsorted(ids, np.arange(0, end + 2 + RANGE, RANGE))
        out = []
        for r in np.flatnonzero(np.diff(edges)).tolist():
            i, j = edges[r], edges[r + 1]
            out.append((kind, r, salt, (ids[i:j] - r * RANGE).astype("<u4").tobytes(), *(c[i:j].astype("<i8").tobytes() for c in columns)))
        return out

    def write_pairs(runs: pd.DataFrame) -> pd.DataFrame:
        b, (keys, counts) = int(runs["bucket"].iloc[0]), merge(runs)
        width = next(n for n in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * n)
        put_array(root, f"pairs-{b}", keys.astype("<u8"))
        put_array(root, f"pair_counts-{b}", np.concatenate([np.array([width] + [0] * 7, np.uint8), counts.astype(f"<u{width}").view(np.uint8)]))
        context, word = pair_of(b, keys, buckets)
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        tally = [np.add.reduceat(x.astype(np.int64), starts) for x in (counts, counts == 1, counts == 2, counts >= 3)]
        rows = by_range("context", b % salts, context[starts], [*tally, tally[0][:0]])
        follows, n = np.unique(word, return_counts=True)
        none = n[:0]
        rows += by_range("follows", b % salts, follows, [n, none, none, none, none])
        size = np.bincount(np.minimum(counts, 5), minlength=6)
        rows.append(("sizes", 0, b % salts, b"", b"", *(np.array([size[k]], "<i8").tobytes() for k in (1, 2, 3, 4))))
        return pd.DataFrame(rows, columns=[x.split(" ")[0] for x in parts.split(", ")])

    def added(rows: pd.DataFrame) -> tuple[str, int, dict[str, np.ndarray]]:
        """Kind, part and dense sums of rows of one part."""
        kind, part = rows["kind"].iloc[0], int(rows["part"].iloc[0])
        size = 1 if kind == "sizes" else min(RANGE, end + 2 - part * RANGE)
        sums = {c: np.zeros(size, np.int64) for c in ("total", "n1", "n2", "n3", "n4")}
        for r in rows.itertuples(index=False):
            ids = np.frombuffer(r.ids, "<u4") if r.ids else slice(None)
            for c, total in sums.items():
                raw = getattr(r, c)
                if raw:
                    total[ids] += np.frombuffer(raw, "<i8")
        return kind, part, sums

    def add_some(rows: pd.DataFrame) -> pd.DataFrame:
        kind, part, sums = added(rows)
        return pd.DataFrame([(kind, part, 0, b"", *(x.astype("<i8").tobytes() if x.any() else b"" for x in sums.values()))], columns=[x.split(" ")[0] for x in parts.split(", ")])

    path = scratch(spark, "tallies")
    dealt(texts.mapInPandas(count_pairs, RUN), buckets, TASK_BUCKETS).applyInPandas(write_pairs, parts).write.option("compression", "zstd").parquet(path)
    summed = lambda condition: spark.read.schema(parts).parquet(path).where(condition).groupBy("kind", "part", "salt").applyInPandas(add_some, parts).groupBy("kind", "part")
    names = ("total", "n1", "n2", "n3", "n4")
    totals = lambda rows: pd.DataFrame([{c: int(x.sum()) for c, x in added(rows)[2].items()}])
    sizes = summed("kind = 'sizes'").applyInPandas(totals, ", ".join(f"{c} long" for c in names)).first()  # one group
    model.discounts2 = discounts(sizes["n1"], sizes["n2"], sizes["n3"], sizes["n4"]).tolist()
    d2 = model.discounts2

    def write_numbers(rows: pd.DataFrame) -> pd.DataFrame:
        kind, part, sums = added(rows)
        total = sums["total"]
        if kind == "context":
            weight = (d2[1] * sums["n1"] + d2[2] * sums["n2"] + d2[3] * sums["n3"]) / np.maximum(total, 1)
            put_array(root, f"context_total-{part}", total.astype("<i8"))
            put_array(root, f"context_weight-{part}", weight.astype("<f8"))
        else:
            put_array(root, f"follows-{part}", total.astype("<i8"))
        size5 = np.bincount(np.minimum(total, 5), minlength=6)
        return pd.DataFrame([(kind, int(total.sum()), *(int(size5[k]) for k in range(1, 6)))], columns=["kind", "total", "n1", "n2", "n3", "n4", "n5"])

    kinds = summed("kind <> 'sizes'").applyInPandas(write_numbers, "kind string, total long, n1 long, n2 long, n3 long, n4 long, n5 long").groupBy("kind")
    follows = next(r[1:] for r in kinds.agg(*[F.sum(c) for c in (*names, "n5")]).collect() if r["kind"] == "follows")  # two rows
    delete(spark, path)
    model.followed = int(follows[0])
    d1 = discounts(*follows[1:5])
    model.discounts1 = d1.tolist()
    model.weight1 = float(d1[1] * follows[1] + d1[2] * follows[2] + d1[3] * (follows[3] + follows[4] + follows[5])) / model.followed
    return model


def score_chunk(model: Model, words: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: n_tokens, n_known, base_score and score."""
    end, begin, v = model.words, model.words + 1, model.distinct
    distinct, inverse = np.unique(words, return_inverse=True)
    found, counted = model.find_words(distinct)
    # local numbers: a batch's distinct words, then the end and the begin
    tokens, before, starts = sequences(inverse.astype(np.int64), sizes, len(distinct), len(distinct) + 1)
    number = np.concatenate([found, [end if model.texts else -1, begin if model.texts else -1]])
    count = np.concatenate([counted, [model.texts, 0]])
    known = np.flatnonzero(number >= 0)
    order = known[np.argsort(number[known])]
    total, weight, follows = np.zeros(len(number), np.int64), np.zeros(len(number)), np.zeros(len(number), np.int64)
    if len(order):
        total[order] = model.by_number("context_total", number[order], "<i8")
        weight[order] = model.by_number("context_weight", number[order], "<f8")
        follows[order] = model.by_number("follows", number[order], "<i8")
    base = np.log10((count + 0.1) / (model.tokens + 0.1 * (v + 1)))
    d1, d2 = np.array(model.discounts1), np.array(model.discounts2)
    lower = np.maximum(follows - d1[np.minimum(follows, 3)], 0) / max(1, model.followed) + model.weight1 / (v + 1)
    p = lower[tokens]
    has = np.flatnonzero(total[before] > 0)
    context, word = before[has], tokens[has]
    pair = np.zeros(len(has), np.int64)
    both = np.flatnonzero((number[word] >= 0) & (number[context] >= 0))
    # pairs of the chunk's own numbers first, so that each is sought once
    local, back = np.unique(context[both] * len(number) + word[both], return_inverse=True)
    pair[both] = model.find_pairs(number[local // len(number)], number[local % len(number)])[back]
    p[has] = np.maximum(pair - d2[np.minimum(pair, 3)], 0) / total[context] + weight[context] * p[has]
    return {
        "n_tokens": sizes + 1,
        "n_known": np.add.reduceat((count[tokens] > 0).astype(np.int64), starts),
        "base_score": np.add.reduceat(base[tokens], starts),
        "score": np.add.reduceat(np.log10(p), starts),
    }


def score(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """key, n_tokens, n_known, base_score, score (log10 of the text's probability) and perplexity of every row."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_field = T.StructField("id", docs.schema[key].dataType)
    schema = T.StructType([id_field, *T._parse_datatype_string("n_tokens long, n_known long, base_score double, score double").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held, words, sizes in chunks(batches, WordHashes()):
            yield pd.DataFrame({"id": pd.concat([b["id"] for b in held], ignore_index=True)} | score_chunk(sent.value, words, sizes))

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.lit(True))
    out = rows.mapInPandas(run, schema)
    perplexity: Column = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return out.select(F.col("id").alias(key), "n_tokens", "n_known", "base_score", "score", perplexity.alias("perplexity"))
