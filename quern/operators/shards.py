"""Shards of a target size, and checksums."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import held, ship, written
from .order import permuted, running

#: Rows with token arrays that one task places.
ROW_BUCKET = 20_000
#: Ids of a range that one task fills, as orders and sizes, and ranges whose tables become one.
RANGE_IDS, SPAN = 1_000_000, 256
#: Characters that the tokenizers library takes at once (it keeps some hundred bytes a token).
SLICE_CHARS = 250_000
#: The table of a range or of neighbouring ones.
FACTS = {"total": "long", "empty_out": "long", "empty_opened": "long", "starts": "binary", "outs": "binary", "opens": "binary"}


def fill(sizes: np.ndarray, target: int, held: int = 0) -> np.ndarray:
    """Next-fit: a new shard when the open one (with `held` at first) has something and the next size would exceed the target."""
    out, shard = np.empty(len(sizes), np.int64), 0
    for i, s in enumerate(sizes.tolist()):
        if held and held + s > target:
            shard, held = shard + 1, 0
        held += s
        out[i] = shard
    return out


def fill_table(sizes: np.ndarray, target: int) -> dict:
    """What a range makes of any fill it is entered with, for `carried`.

    The place of the first new shard falls as the fill that comes in grows, so the table has a row per such
    place: the fill that goes out and the shards opened. Neighbours with the same outcome are one row.
    """
    n, ends = len(sizes), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def opens(base):
        """The place of the next shard, if the open one begins where the running sum is `base`."""
        return np.maximum(np.searchsorted(ends, base, "right"), np.searchsorted(ends, base + target, "right") - 1)

    last, opened = np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
    after = np.append(np.minimum(opens(ends[:n]), n), n)
    while (after < n).any():  # the chains of shards, doubled: the last shard of each and how many
        last, opened, after = np.where(after < n, last[after], last), opened + opened[after], after[after]
    out = ends[n] - ends[last]
    first = int(min(opens(0), n))
    reach = max(1, int(np.searchsorted(ends[:n], target, "left")))
    new = np.ones(reach, bool)
    new[1:] = (out[1:reach] != out[: reach - 1]) | (opened[1:reach] != opened[: reach - 1])
    at = np.flatnonzero(new)
    return {
        "total": int(ends[n]), "empty_out": int(out[first] if first < n else ends[n]), "empty_opened": int(opened[first]),
        "starts": ends[at].tobytes(), "outs": out[at].tobytes(), "opens": opened[at].tobytes(),
    }


def carried(row: dict, target: int, held: int) -> tuple[int, int]:
    """The fill after a range with this table and the shards opened in it."""
    if not held:
        return row["empty_out"], row["empty_opened"]
    if held + row["total"] <= target:
        return held + row["total"], 0
    starts, outs, opens = (np.frombuffer(row[c], np.int64) for c in ("starts", "outs", "opens"))
    at = max(0, int(np.searchsorted(starts, target - held, "right")) - 1)
    return int(outs[at]), int(opens[at])


def composed(tables: list[dict], target: int) -> dict:
    """One table for neighbouring ranges: what they make of any fill the first is entered with.

    Where a range opens a shard, what follows depends on its outcome only; where it opens none, the next range sees the
    fill so much higher, so its rows are shifted by the range's total.
    """
    out = tables[0]
    for row in tables[1:]:
        starts, outs, opens = (np.frombuffer(out[c], np.int64) for c in ("starts", "outs", "opens"))
        led = [carried(row, target, int(o)) for o in outs]
        own = starts < out["total"]
        later, last, opened = (np.frombuffer(row[c], np.int64) for c in ("starts", "outs", "opens"))
        behind = later + out["total"] < target
        starts = np.concatenate([starts[own], later[behind] + out["total"]])
        outs = np.concatenate([np.array([x[0] for x in led], np.int64)[own], last[behind]])
        opens = np.concatenate([opens[own] + np.array([x[1] for x in led], np.int64)[own], opened[behind]])
        new = np.append(True, (outs[1:] != outs[:-1]) | (opens[1:] != opens[:-1])) if len(outs) else np.empty(0, bool)
        held, more = carried(row, target, out["empty_out"])
        out = {"total": out["total"] + row["total"], "empty_out": held, "empty_opened": out["empty_opened"] + more, "starts": starts[new].tobytes(), "outs": outs[new].tobytes(), "opens": opens[new].tobytes()}
    return out


def next_fit(df: DataFrame, by: str, order: str, size: str, target: int, blocks: int | None = None) -> DataFrame:
    """by, order (unique in its group) and shard: exact next-fit, in ranges of RANGE_IDS rows or in about `blocks` even ones.

    Next-fit is a chain, but what a range does depends on its rows before only by the fill of the open shard.
    So every range makes a table from the fill that comes in to the one that goes out. Tables compose: those of
    SPAN ranges become one, a task walks the spans of a group, each span walks its ranges, and the ranges are filled
    with what they are entered with. No task sees the tables of a whole group. Ranges only share out the work: the shards
    are the same with any of them, and where one holds every group there is nothing to share. Ranges are cut by
    the number of rows, so ids may be as sparse as they like; a null group is a group.
    """
    rows = df.select(by, order, F.col(size).cast("long").alias("_size"))
    most = rows.groupBy(by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    width = RANGE_IDS if blocks is None else max(1, -(-most // blocks))
    kind = {c: df.schema[c].dataType.simpleString() for c in (by, order)}
    ship(df.sparkSession)
    result = f"{by} {kind[by]}, {order} {kind[order]}, shard int"

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([order, "_size"])
        base, held = (int(rows[c].iloc[0]) if c in rows else 0 for c in ("_base", "_held"))
        return rows.assign(shard=base + fill(rows["_size"].to_numpy(), target, held))[[by, order, "shard"]]

    if most <= width:
        return rows.groupBy(by).applyInPandas(place, result)
    block = F.floor(F.col("_place") / width).cast("int").alias("_block")
    placed = written(running(rows, None, order, F.lit(1).cast("long"), "_place", by=(by,)).select(by, order, "_size", block), "ranges")

    def table(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values([order, "_size"])["_size"].to_numpy()
        return pd.DataFrame([{by: rows[by].iloc[0], "_block": rows["_block"].iloc[0]} | fill_table(sizes, target)])

    def join_up(tables: pd.DataFrame) -> pd.DataFrame:
        ordered = tables.sort_values("_block")
        return pd.DataFrame([{by: ordered[by].iloc[0], "_span": ordered["_span"].iloc[0]} | composed(ordered[list(FACTS)].to_dict("records"), target)])

    def walk(tables: pd.DataFrame, step: str) -> pd.DataFrame:
        shard, held = (int(tables[c].iloc[0]) if c in tables else 0 for c in ("_base", "_held"))
        entered = []
        for row in tables.sort_values(step).to_dict("records"):
            entered.append((row[by], row[step], shard, held))
            held, opened = carried(row, target, held)
            shard += opened
        return pd.DataFrame(entered, columns=[by, step, "_base", "_held"])

    facts = ", ".join(f"{c} {t}" for c, t in FACTS.items())
    ranges = placed.groupBy(by, "_block").applyInPandas(table, f"{by} {kind[by]}, _block int, {facts}")
    tables = written(ranges.withColumn("_span", F.floor(F.col("_block") / SPAN).cast("int")), "tables")
    spans = tables.groupBy(by, "_span").applyInPandas(join_up, f"{by} {kind[by]}, _span int, {facts}")
    entries = lambda step: f"{by} {kind[by]}, {step} int, _base long, _held long"
    into = spans.groupBy(by).applyInPandas(lambda t: walk(t, "_span"), entries("_span"))
    within = _matched(tables, into, by, "_span").groupBy(by, "_span").applyInPandas(lambda t: walk(t, "_block"), entries("_block"))
    return _matched(placed, within, by, "_block").groupBy(by, "_block").applyInPandas(place, result)


def _matched(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """left with the other columns of right, on keys of which nulls match."""
    other = right.select(*[F.col(k).alias(f"_right{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    return left.join(other, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_right{i}")) for i, k in enumerate(keys)))).drop(*[f"_right{i}" for i in range(len(keys))])


def windows(tokens: DataFrame, by: str, order: str, column: str, length: int) -> DataFrame:
    """Sequences of exactly `length` tokens: a group's token arrays in order (a whole number, unique in its group), cut across their borders; the tail is dropped.

    Rows give by, sequence (from 0) and input_ids.
    """
    whole = gathered(parts(written(sized(tokens, by, order, column), "tokens"), by, order, column, length), by)
    return whole.where(F.size("input_ids") == length)


def sized(tokens: DataFrame, by: str, order: str, column: str) -> DataFrame:
    """by, order, the token array and its `_size`, where it has tokens. To be written before `parts`, as tokens are dear: sums read the sizes alone."""
    made = held(tokens.select(by, order, F.col(column).alias("_made")), column, F.col("_made")).drop("_made")
    return made.withColumn("_size", F.size(column).cast("long")).where("_size > 0")


def parts(rows: DataFrame, by: str, order: str, column: str, length: int, before: DataFrame | None = None) -> DataFrame:
    """by, sequence, _from (the place in the group) and _part of `sized` rows.

    Offsets are running sums over buckets of the order; each row is cut into the parts that fall into one
    sequence, so a shuffle moves parts, not tokens. `before` has by and `_before`, the tokens of a group that precede these rows.
    """
    placed = running(rows, None, order, F.col("_size"), "_at", by=(by,), rows=ROW_BUCKET)
    if before is not None:
        past = before.select(F.col(by).alias("_group"), "_before")
        placed = placed.join(past, F.col(by).eqNullSafe(F.col("_group")), "left").withColumn("_at", F.col("_at") + F.coalesce("_before", F.lit(0)))
    first, last = F.floor(F.col("_at") / length), F.floor((F.col("_at") + F.size(column) - 1) / length)
    pieces = placed.withColumn("_seq", F.explode(F.sequence(first, last)))
    start = F.greatest(F.lit(0), F.col("_seq") * length - F.col("_at"))
    end = F.least(F.size(column).cast("long"), (F.col("_seq") + 1) * length - F.col("_at"))
    return pieces.select(by, F.col("_seq").alias("sequence"), (F.col("_at") + start).alias("_from"), F.slice(column, (start + 1).cast("int"), (end - start).cast("int")).alias("_part"))


def gathered(pieces: DataFrame, by: str) -> DataFrame:
    """by, sequence and input_ids: the `parts` of each sequence, joined in their order."""
    return pieces.groupBy(by, "sequence").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_from", "_part"))), lambda x: x["_part"])).alias("input_ids"))


def batches(sequences: DataFrame, part: str, order: str, column: str, size: int, factor: int = 1, epoch: int | None = None, seed: int = 0) -> DataFrame:
    """batch, place (in its batch, from 0) and input_ids of full batches of `size`: the parts in sorted order, one after the other.

    With an epoch, in that epoch's order of all sequences (`order.permuted`), which each row finds by itself.
    `order` counts a part's sequences from 0. With a factor, that many neighbours (across parts) are one
    sequence. What does not fill a sequence or a batch is dropped.
    """
    return batched(*numbered(sequences, part, order, column, factor), column, size, epoch, seed)


def numbered(sequences: DataFrame, part: str, order: str, column: str, factor: int = 1) -> tuple[DataFrame, int]:
    """_k (from 0) and the tokens of all sequences in the order of `batches`, and their number: for several epochs, write them once."""
    ends = sequences.groupBy(part).agg((F.max(order) + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per part
    total = ends.agg(F.sum("_n")).first()[0] or 0
    out = sequences.join(ends.select(part, before.alias("_o")), part).select((F.col("_o") + F.col(order)).alias("_k"), column)
    if factor > 1:
        rows = out.groupBy(F.floor(F.col("_k") / factor).alias("_g")).agg(F.array_sort(F.collect_list(F.struct("_k", column))).alias("_all"))
        out = rows.where(F.size("_all") == factor).select(F.col("_g").alias("_k"), F.flatten(F.transform("_all", lambda x: x[column])).alias(column))
    return out, total // factor


def batched(rows: DataFrame, n: int, column: str, size: int, epoch: int | None = None, seed: int = 0) -> DataFrame:
    """The batches of `numbered` sequences."""
    if epoch is not None:
        rows = rows.withColumn("_k", permuted(F.col("_k"), n, seed, epoch))
    batch = F.floor(F.col("_k") / size)
    return rows.where(batch < n // size).select(batch.alias("batch"), (F.col("_k") % size).cast("int").alias("place"), column)


def full_batches(df: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """df with `batch`: rows by key (a whole number), then `order`, in full batches; the rest is dropped."""
    sizes = df.groupBy(key).agg(F.count("*").alias("_n"))
    ahead = running(sizes, None, key, F.col("_n"), "_before")
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    local = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    same = df.withColumn("_l", local).alias("x").join(ahead.select(F.col(key).alias("_key"), "_before"), F.col(f"x.{key}").eqNullSafe(F.col("_key")))
    numbered = same.withColumn("_k", F.col("_before") + F.col("_l")).where(F.col("_k") < total // size * size)
    return numbered.select(*df.columns, F.floor(F.col("_k") / size).alias("batch"))


def chunked_lines(df: DataFrame, order: str, text: str, chunk: int, most: int, shortest: int = 20) -> DataFrame:
    """order, line (JSON with its line feed), size and chunk of a download: texts of at least `shortest` characters, up to `most` bytes, in chunks of `chunk` bytes.

    Rows come in the order of `order` (a whole number, unique). The first line that would exceed `most` ends
    the download. A chunk ends before the line that would exceed it; a larger line has a chunk of its own.
    """
    fit = df.where(F.length(text) >= shortest).select(order, F.concat(F.to_json(F.struct(F.col(text).alias("text"))), F.lit("\n")).alias("line"))
    sized = fit.withColumn("size", F.octet_length("line").cast("long"))
    taken = running(sized.select(order, "size"), None, order, F.col("size"), "_before").where(F.col("_before") + F.col("size") <= most)
    placed = next_fit(taken.select(F.lit("lines").alias("_all"), order, "size"), "_all", order, "size", chunk)
    return sized.join(placed.select(order, F.col("shard").alias("chunk")), order)


def download_counts(df: DataFrame, lines: DataFrame, order: str, text: str, shortest: int = 20) -> DataFrame:
    """One row of a download's counters: rows seen (up to the line that ended it), rows and bytes written, chunks."""
    done = lines.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.max("chunk") + 1, F.lit(0)).alias("chunks"), F.max(order).alias("last")).first()
    after = F.lit(True) if done["last"] is None else F.col(order) > done["last"]
    ended = df.where((F.length(text) >= shortest) & after).agg(F.min(order)).first()[0]
    seen = df if ended is None else df.where(F.col(order) <= ended)
    return seen.agg(
        F.count("*").alias("rows_seen"), F.lit(done["n"]).cast("long").alias("rows_written"), F.lit(done["bytes"]).cast("long").alias("text_bytes"), F.lit(done["chunks"]).cast("int").alias("chunks")
    )


def joined_windows(sequences: DataFrame, by: str, factor: int) -> DataFrame:
    """`factor` neighbouring sequences as one; what is left over is dropped."""
    group = F.floor(F.col("sequence") / factor)
    rows = sequences.groupBy(by, group.alias("sequence")).agg(F.array_sort(F.collect_list(F.struct(F.col("sequence").alias("_n"), "input_ids"))).alias("_all"))
    return rows.where(F.size("_all") == factor).select(by, "sequence", F.flatten(F.transform("_all", lambda x: x["input_ids"])).alias("input_ids"))


def checksums(files: DataFrame) -> DataFrame:
    """folder and a map from path to SHA-256 of its files, in the order of paths, of a binaryFile scan; checksums.json itself is left out."""
    rows = files.where(~F.col("path").endswith("checksums.json")).select("path", F.sha2("content", 256).alias("sha256"))
    folder = F.regexp_extract("path", "^(?:(.*)/)?[^/]*$", 1).alias("folder")
    return rows.groupBy(folder).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "sha256")))).alias("checksums"))


def file_manifest(files: DataFrame) -> DataFrame:
    """path, split_name, format, compression, size_bytes and sha256 of each file."""
    from ..functions.text import path_facts

    return files.select("path", *[c.alias(n) for n, c in path_facts(F.col("path")).items()], F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def slices(values: list, most: int) -> Iterator[list]:
    """The values in order, in lists of a total length of `most` (a longer value is alone)."""
    out, held = [], 0
    for v in values:
        if out and held + len(v) > most:
            yield out
            out, held = [], 0
        out.append(v)
        held += len(v)
    if out:
        yield out


def encode(df: DataFrame, column: str, path: str, out: str = "ids", end_id: int | None = None) -> DataFrame:
    """df with the ids of a tokenizers file (loaded once per worker) and, if given, an end id after them."""
    ship()

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        last = [] if end_id is None else [end_id]
        for batch in batches:
            ids = []  # as arrays; what the library keeps besides ids is there for a slice only
            for texts in slices([t or "" for t in batch], SLICE_CHARS):
                ids += [np.array(e.ids + last, np.int32) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            yield pd.Series(ids, dtype=object)

    return df.withColumn(out, encoded(F.col(column)))


def decode(df: DataFrame, column: str, path: str, out: str = "text", skip_special: bool = True) -> DataFrame:
    """df with the text of ids."""
    ship()

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            yield pd.Series([t for ids in slices(list(batch), SLICE_CHARS // 4) for t in tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=skip_special)], dtype=object)

    return df.withColumn(out, decoded(F.col(column)))
