"""MinHash near-duplicates: fast similarity sketching, banding, exact verification.

A document is its set of distinct shingles (`words` consecutive words; a shorter text is one shingle).
Documents are linked if |A and B| / |A or B| reaches the threshold on full sets, and a component is
what links connect. Steps:

1. Sketch. Each shingle is thrown into one of t bins per round; a bin keeps the least (round, value).
   Rounds t to 2t - 1 throw everything into bin round - t, so every bin fills, and a document stops
   as soon as its bins are full. Agreement of two sketches is concentrated around their similarity.
2. Equal sets form one class (a 128-bit digest of the set), so copies cost one row from here on.
3. Bands of `rows` bins put classes into buckets. At a similarity of 0.85, 25 bands of 5 rows miss a
   link with probability 4e-7; links near 1 practically never.
4. Every bucket's members are verified on full sets against its most connected member; components.
5. Pairs of members of a bucket that are still in different components are verified too, but for those
   that an exact bound excludes: odd sketches of two sets differ in no more bits than the sets in
   elements, so too many differing bits rule a link out. The bound is part of the join; none is capped.
   Members of a bucket's largest component are compared with the others only.
6. Components again, then the least id of each.

No step collects links, and no step emits the pairs of a bucket whose members are already connected. A bucket
of more than BLOCK members is cut into parts by the members' digests: what is known of the bucket is dealt to
all parts, and members of two parts meet in a task of their own, so that no bucket lands in one task. Between a
bucket's largest component and the others the larger side is dealt out once and the smaller goes to all of its parts; among o
others there are o^2 / BLOCK rows and o^2 comparisons at most.

Texts of any length are taken whole; repeated rows are documents of one class; an empty table gives no rows;
columns of df other than key and text are not read. Nulls and empty texts have no shingles: they are linked with nothing. A row with a null id is linked
with nothing and has a null component. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ship, trim, written

#: Ids that may be broadcast (8 bytes each); beyond that the join is shuffled.
BROADCAST_IDS = 1_000_000
#: Entries of a worker's cache of word hashes; it starts anew beyond that.
CACHE_WORDS = 100_000
#: Bits of the sketches that bound how far two sets differ, a power of two.
ODD_BITS = 2048
#: Documents sketched at once.
CHUNK = 1024
#: Members of a bucket that one task takes.
BLOCK = 512

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _multiple(i: int) -> np.uint64:
    return np.uint64((i * _STEP) & 0xFFFFFFFFFFFFFFFF)


class WordHashes(dict):
    """64-bit hashes of words."""

    def __init__(self):
        super().__init__()
        import xxhash

        self.hash = xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self.hash(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def word_list(text: str) -> list[bytes]:
    """Words between white space (U+0020, U+0009 to U+000D) with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    seq = word_list(text or "")
    if not seq:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, seq), np.uint64, len(seq))
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, _multiple(size), np.uint64)
    for i in range(size):
        total = mix(total + h[i : len(h) - size + 1 + i] + _multiple(i + 1))
    return np.unique(total)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of t values per set; the sets must not be empty."""
    n = len(sets)
    out = np.full(n * t, _EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    elements, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * t):
        h = mix(elements + _multiple(i + 1))
        place = owner * t + (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64) if i < t else owner * t + (i - t)
        np.minimum.at(out, place, np.uint64(i << 32) | (h & low))
        live = np.unique(owner) if i == 0 else live[open_]
        open_ = (out.reshape(n, t)[live] == _EMPTY).any(axis=1)
        if not open_.any():
            break
        if not open_.all():
            still = np.zeros(n, bool)
            still[live[open_]] = True
            keep = still[owner]
            elements, owner = elements[keep], owner[keep]
    return out.reshape(n, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A signed 64-bit key per set and band."""
    out = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sketches), _multiple(b + 1), np.uint64)
        for r in range(rows):
            key = mix(key + sketches[:, b * rows + r])
        out[:, b] = key
    return out.view(np.int64)


def features(df: DataFrame, key: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """A row per row of df: id, n_shingles, digest of the set (null without shingles), band keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.iloc[at : at + CHUNK]
                sets = [shingle_set(t, words, hashes) for t in part["text"]]
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(sketch(full, bands * rows), bands, rows) if full else ())
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "n_shingles": np.array([len(s) for s in sets], np.int64),
                        "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        "keys": [next(keys) if len(s) else np.empty(0, np.int64) for s in sets],
                    }
                )
        hashes.clear()
        trim()

    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, n_shingles long, digest binary, keys array<long>")


def sets_of(df: DataFrame, key: str, text: str, ids: DataFrame, n_ids: int, words: int) -> DataFrame:
    """digest and shingles (sorted hashes) of the documents whose id is among ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            sets = [s for s in (shingle_set(t, words, hashes) for t in batch["text"]) if len(s)]
            yield pd.DataFrame(
                {"digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "shingles": [s.view(np.int64) for s in sets], "odd": [odd_sketch(s) for s in sets]}
            )
        hashes.clear()
        trim()

    ship(df.sparkSession)
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    wanted = docs.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "id", "left_semi")
    return wanted.select("text").mapInPandas(run, "digest binary, shingles array<long>, odd array<long>").dropDuplicates(["digest"])


def odd_sketch(elements: np.ndarray) -> np.ndarray:
    """ODD_BITS bits in 64-bit words: which slots an odd number of elements falls into.

    An element that two sets do not share flips one bit, so the bits in which their sketches differ are
    never more than the elements in which the sets differ.
    """
    count = np.bincount((elements >> np.uint64(17)).astype(np.int64) & (ODD_BITS - 1), minlength=ODD_BITS)
    return np.packbits((count & 1).astype(np.uint8)).view(np.int64)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and comp (the same for connected nodes) by contraction.

    Every round each node takes the least label next to it; edges are rewritten to labels and loops
    dropped. Labels must be in random order (digests are), so that few rounds are needed.
    """
    out = nodes.select("node", F.col("node").alias("comp"))
    live = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        step = written(both.groupBy("a").agg(F.min("b").alias("b")).where("b < a").select(F.col("a").alias("comp"), F.col("b").alias("to")), "step")
        out = out.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
        new = lambda side: F.coalesce(F.col(f"{side}_to"), F.col(side))
        moved = live
        for side in ("a", "b"):
            moved = moved.join(step.select(F.col("comp").alias(side), F.col("to").alias(f"{side}_to")), side, "left")
        live = written(moved.select(F.least(new("a"), new("b")).alias("a"), F.greatest(new("a"), new("b")).alias("b")).where("a <> b").distinct(), "edges")
    return written(out, "components")


def _parts(size: Column) -> Column:
    return F.ceil(size / BLOCK).cast("int")


def _own_part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("digest"), parts).cast("int")


def _dealt(members: DataFrame, name: str = "salt") -> DataFrame:
    """Members (bucket, digest, size) with the part of their bucket that they are in."""
    return members.withColumn(name, _own_part(_parts(F.col("size"))))


def _to_all(buckets: DataFrame, name: str = "salt") -> DataFrame:
    """Rows (bucket, size) once for each part of their bucket."""
    return buckets.withColumn(name, F.explode(F.sequence(F.lit(0), _parts(F.col("size")) - 1)))


def _linked(overlap: Column, na: Column, nb: Column, threshold: tuple[int, int]) -> Column:
    part, whole = threshold
    return overlap * whole >= (na + nb - overlap) * part


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (digests a, b) linked on their full sets."""
    one = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    overlap = F.size(F.array_intersect("sa", "sb"))
    return both.where(_linked(overlap, F.size("sa"), F.size("sb"), threshold)).select("a", "b")


def near_duplicates(df: DataFrame, key: str, text: str, threshold: tuple[int, int] = (85, 100), words: int = 5, bands: int = 25, rows: int = 5) -> DataFrame:
    """A row per row of df: the id, n_shingles, component_id (the least id of its component) and kept."""
    part, whole = threshold
    feat = written(features(df, key, text, words, bands, rows), "features")
    real = feat.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    members = real.select("digest", F.col("n_shingles").alias("n"), "keys").dropDuplicates(["digest"]).select("digest", "n", F.explode("keys").alias("bucket"))
    sizes = written(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    large = sizes.where(F.col("size") > BLOCK)
    # sizes of large buckets go to all tasks where their number is bounded; beyond that, members of a bucket stay together here
    split = large.count() <= BROADCAST_IDS
    known = members.join(F.broadcast(large), "bucket", "left") if split else members.withColumn("size", F.lit(None).cast("long"))
    known = _dealt(known.withColumn("size", F.coalesce("size", F.lit(1)))).drop("size")
    whole_sizes = _to_all(sizes) if split else sizes.withColumn("salt", F.lit(0))
    cand = written(known.join(whole_sizes, ["bucket", "salt"]).select("bucket", "digest", "n", "size"), "candidates")
    heads = written(real.groupBy("digest").agg(F.min("id").alias("head"), F.count("*").alias("size")), "heads")
    classes = written(cand.groupBy("digest").agg(F.sum("size").alias("weight"), F.first("n").alias("n")).join(heads.select("digest", "head"), "digest"), "classes")
    n_classes = classes.count()
    sets = written(sets_of(df, key, text, classes.select(F.col("head").alias("id")).distinct(), n_classes, words).join(classes.select("digest"), "digest", "left_semi"), "sets")

    # the most connected member of each bucket against all others of the bucket
    close = lambda x, y: (F.least(x, y) * whole >= F.greatest(x, y) * part)
    ranked = cand.join(classes.select("digest", "weight"), "digest")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("weight", "digest", "n")).alias("hub"), F.max("size").alias("size"))
    stars = _dealt(cand).drop("size").join(_to_all(hubs), ["bucket", "salt"]).where((F.col("digest") != F.col("hub.digest")) & close(F.col("n"), F.col("hub.n")))
    star_pairs = written(stars.select(F.least("digest", "hub.digest").alias("a"), F.greatest("digest", "hub.digest").alias("b")).distinct(), "stars")
    links = written(verified(star_pairs, sets, threshold), "links")
    nodes = classes.select(F.col("digest").alias("node"))
    first = components(nodes, links)

    # what remains in different components of a bucket
    label = first.select(F.col("node").alias("digest"), "comp")
    labelled = written(_dealt(cand).join(label, "digest"), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("size").alias("size")).where("x <> y").select("bucket", "size")
    open_ = written(labelled.join(_to_all(mixed).drop("size"), ["bucket", "salt"]), "open")
    if not open_.isEmpty():
        odd = [f"o{i}" for i in range(ODD_BITS // 64)]
        marked = sets.select("digest", *[F.col("odd")[i].alias(c) for i, c in enumerate(odd)])
        # a bucket's largest component (copies of one text, as a rule) meets the others only, not itself
        counted = open_.groupBy("bucket", "comp").agg(F.count("*").alias("count"), F.max("size").alias("size"))
        main = counted.groupBy("bucket").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.max("count").alias("inside"), F.sum("count").alias("all"), F.max("size").alias("size"))
        full = open_.join(marked, "digest").join(_to_all(main).drop("size"), ["bucket", "salt"]).drop("salt")
        full = full.withColumn("main", F.col("comp") == F.col("main")).withColumn("outside", F.col("all") - F.col("inside"))
        inner, outer = full.where("main"), full.where(~F.col("main"))
        differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in odd), F.lit(0))
        total = F.col("x.n") + F.col("y.n")

        def near(x: DataFrame, y: DataFrame, on: list[str], apart: Column) -> DataFrame:
            same = reduce(lambda a, b: a & b, (F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("bucket", *on)))
            met = x.alias("x").join(y.alias("y"), same & apart & (differ * (whole + part) <= total * (whole - part)))
            return met.select(F.least("x.digest", "y.digest").alias("a"), F.greatest("x.digest", "y.digest").alias("b"))

        # the larger side of a bucket is dealt to parts once, the smaller goes to all of them
        parts, wide = _parts(F.greatest("inside", "outside")), F.col("inside") >= F.col("outside")
        spread = lambda rows, once: rows.withColumn("salt", F.explode(F.when(once, F.array(_own_part(parts))).otherwise(F.sequence(F.lit(0), parts - 1))))
        between = near(spread(outer, ~wide), spread(inner, wide), ["salt"], F.lit(True))
        # among the others every part meets every part
        block = _parts(F.col("outside"))
        every = lambda rows, own, other: rows.withColumn(own, _own_part(block)).withColumn(other, F.explode(F.sequence(F.lit(0), block - 1)))
        among = near(every(outer, "salt", "other"), every(outer, "other", "salt"), ["salt", "other"], F.col("x.comp") < F.col("y.comp"))
        rest = between.union(among).distinct()
        more = verified(rest.join(star_pairs, ["a", "b"], "left_anti"), sets, threshold)
        links = written(links.union(more), "links")
        first = components(nodes, links)

    found = classes.select("digest", "head").join(first.select(F.col("node").alias("digest"), "comp"), "digest")
    least_id = written(found.groupBy("comp").agg(F.min("head").alias("component_id"), F.count("*").alias("size")), "least")
    # classes of a large component share a key: these few components go to all tasks where their number is bounded
    crowded = least_id.where(F.col("size") > BLOCK)
    if 0 < crowded.count() <= BROADCAST_IDS:
        told = found.join(F.broadcast(crowded.select("comp", F.col("component_id").alias("told"))), "comp", "left")
        small = told.where(F.col("told").isNull()).join(least_id.where(F.col("size") <= BLOCK), "comp").select("digest", "component_id")
        named = small.union(told.where(F.col("told").isNotNull()).select("digest", "told"))
    else:
        named = found.join(least_id, "comp").select("digest", "component_id")
    final = heads.join(named, "digest", "left").select("digest", "size", F.coalesce("component_id", "head").alias("component_id"))
    grouped = F.col("id").isNotNull() & F.col("digest").isNotNull()
    # rows that no group takes do not go through the join, where they would all meet
    alone = feat.where(~grouped).select(F.col("id").alias(key), "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    rows = feat.where(grouped).select("id", "n_shingles", "digest")
    # sets of many rows are dealt to parts as buckets are, by the rows' ids
    many = heads.where(F.col("size") > BLOCK).select("digest", "size")
    if many.count() <= BROADCAST_IDS:
        rows = rows.join(F.broadcast(many), "digest", "left").withColumn("salt", F.pmod(F.xxhash64("id"), _parts(F.coalesce("size", F.lit(1)))).cast("int")).drop("size")
        final = _to_all(final)
    else:
        rows, final = rows.withColumn("salt", F.lit(0)), final.withColumn("salt", F.lit(0))
    out = rows.join(final.drop("size"), ["digest", "salt"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept")).unionByName(alone)
