"""Media columns for GIF: LZW code streams, palettes, disposal and transparency, timed frames.

`store` writes byte payloads losslessly as indexed GIF images (one byte, one pixel; grey palette).
`frames` decodes any GIF column into one row per frame with timing, the frame's indices, the composed
canvas and a colour histogram. `load` reads a stored payload back through the same decoder, as digests
and a list of its timed frames with their histograms.

Frames leave the decoder one by one, so that a worker holds one canvas. A canvas or an image of more than
`max_pixels` (MAX_PIXELS unless told otherwise) is an error, as its header alone could ask for any memory.

Null, empty, broken and too large media never fail a job: `frames` gives the frames before the fault and a
row with `error` and no frame, `load` gives null digests and `error` (and no error for a null). Repeated
rows are decoded as often as they occur, an empty table gives no rows; columns of df named like those made
are replaced. Interlaced images, local palettes, all disposal methods, clear codes at any place and
deferred clears are handled.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh, ship

#: Pixels in a row and rows in a frame that `store` writes.
WIDTH, ROWS = 64, 2048
#: Hundredths of a second that `store` gives each frame.
DELAY = 10
#: Pixels of a canvas or an image, at most: 3 bytes each.
MAX_PIXELS = 1 << 24
LEVELS = 4
FRAME_SCHEMA = (
    "frame int, n_frames int, left int, top int, width int, height int, delay_cs int, disposal int, transparent int, "
    "indices binary, canvas_width int, canvas_height int, canvas_rgb binary, histogram array<int>, error string"
)


class GifError(ValueError):
    """The bytes are no whole GIF."""


def _plan(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offsets and widths of the codes after a clear code, up to a full table.

    The n-th code (from 0) follows n - 1 new table entries, so its width depends on n only.
    """
    first = (1 << bits) + 2
    n = np.arange((1 << 12) - first + 2)
    entries = first + np.maximum(n - 1, 0)
    widths = np.minimum(12, np.frexp(entries.astype(np.float64))[1])
    return np.concatenate([[0], np.cumsum(widths)[:-1]]), widths


_PLANS = {b: _plan(b) for b in range(2, 9)}
_MASKS = {b: ((1 << widths) - 1).astype(np.uint32) for b, (_, widths) in _PLANS.items()}
#: What a byte is as a prefix: its code with eight bits free for the next byte.
_ROOTS = [byte << 8 for byte in range(256)]
#: The palette that `store` writes.
_GREY = bytes(v for i in range(256) for v in (i, i, i))


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """GIF's LZW: least significant bit first, a clear code whenever the table is full."""
    clear, end, first = 1 << bits + 8, (1 << bits) + 1 << 8, (1 << bits) + 2 << 8
    offsets, widths = _PLANS[bits]
    # a prefix's key with the next byte finds its code, or adds one: keys in their order are the codes written, above eight bits of the byte
    codes, ends, table, full, free = [clear], [], {}, 1 << 20, first
    entry, roots, rest = table.setdefault, _ROOTS, iter(data)
    if data:
        prefix = roots[next(rest)]
    for byte in rest:
        code = entry(prefix + byte, free)
        if code != free:
            prefix = code
            continue
        prefix = roots[byte]
        free += 256
        if free == full:
            codes += table
            codes.append(clear)
            ends.append(len(codes))
            table.clear()
            free = first
    codes += table
    codes += [prefix, end] if data else [end]
    ends.append(len(codes))
    # each run begins after a clear code and ends with one, or with the end code
    begin, at, places = 1, bits + 1, [np.zeros(1, np.int64)]
    for stop in ends:
        places.append(offsets[: stop - begin] + at)
        at += int(offsets[stop - begin - 1] + widths[stop - begin - 1])
        begin = stop
    place = np.concatenate(places)
    # a code has 12 bits at most, so it lies in three bytes; bits of different codes never meet, so sums are unions
    spread, byte, size = np.fromiter(codes, np.int64, len(codes)) >> 8 << (place & 7), place >> 3, (at + 7 >> 3) + 2
    parts = [np.bincount(byte + i, spread >> 8 * i & 255, size) for i in range(3)]
    return (parts[0] + parts[1] + parts[2]).astype(np.uint8)[:-2].tobytes()


def _run(codes: np.ndarray, bits: int, size: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """At most `size` pixels of the codes after a clear code, and where each code's pixels begin and how many they are.

    Entry e of the table is the e-th code's pixels and the next one, so each pixel of a code is a copy of an earlier pixel:
    both the lengths and the pixels come by following such links, twice as far each time. A pixel takes 24 bytes meanwhile;
    the codes of one table have 8.4 million pixels at most, and 131,072 (WIDTH * ROWS) in what `store` writes.
    """
    order = np.arange(len(codes))
    entry = codes.astype(np.int64) - ((1 << bits) + 2)
    if (entry >= np.maximum(order, 1)).any() or codes[:1].max(initial=0) >= 1 << bits:
        raise GifError("a code beyond the table")
    copied = entry >= 0
    link, length = np.where(copied, entry, order), copied.astype(np.int64)
    while (more := length.take(link)).any():
        length += more
        link = link.take(link)
    length += 1
    begin = length.cumsum() - length
    n = int(begin.searchsorted(size))
    # a pixel is as far from the one that it copies as its code from that code
    source = np.where(copied, begin.take(entry, mode="wrap") - begin, 0)[:n].repeat(length[:n])
    source += np.arange(len(source))
    while not np.array_equal(further := source.take(source), source):
        source = further
    pixels = np.zeros(len(source), np.uint8)
    pixels[begin[:n]] = codes[:n]
    return pixels.take(source[:size]).tobytes(), begin, length


def lzw_decode(stream: bytes, bits: int, size: int) -> bytes:
    """At most `size` pixels from a code stream."""
    clear, end, first = 1 << bits, (1 << bits) + 1, (1 << bits) + 2
    offsets, widths = _PLANS[bits]
    masks = _MASKS[bits]
    padded = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    words = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16
    total = len(stream) * 8
    out: list[bytes] = []
    made, at = 0, 0
    while made < size:
        if at + bits < total and int(words[at >> 3]) >> (at & 7) & (2 << bits) - 1 == clear:
            at += bits + 1
            continue
        count = int(np.searchsorted(offsets + widths, total - at, side="right"))
        if not count:
            break
        place = at + offsets[:count]
        codes = words[place >> 3] >> (place & 7).astype(np.uint32) & masks[:count]
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else count
        pixels, begin, length = _run(codes[:stop], bits, size - made)
        out.append(pixels)
        made += len(pixels)
        if len(stops):
            at = int(place[stop] + widths[stop])
            if codes[stop] == end:
                break
        elif count < len(offsets):
            break
        else:  # a full table without a clear code: 12 bits each until one comes
            at = int(place[-1] + widths[-1])
            known = out[-1]
            while made < size and at + 12 <= total:
                code = int(words[at >> 3]) >> (at & 7) & 0xFFF
                at += 12
                if code in (clear, end):
                    break
                if code < clear:
                    out.append(bytes([code]))
                else:
                    start = int(begin[code - first])
                    out.append(known[start : start + int(length[code - first]) + 1])
                made += len(out[-1])
            if made >= size or code == end or code != clear:
                break
    return b"".join(out)[:size]


def _blocks(data: bytes) -> bytes:
    out = [bytes([len(part := data[i : i + 255])]) + part for i in range(0, len(data), 255)]
    return b"".join(out) + b"\0"


def encode_payload(payload: bytes) -> bytes:
    """A GIF whose pixels, frame by frame, are the payload; its length must be a positive multiple of WIDTH."""
    if not payload or len(payload) % WIDTH:
        raise ValueError(f"the payload must be a positive multiple of {WIDTH} bytes long")
    height = min(ROWS, len(payload) // WIDTH)
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, height, 0xF7, 0, 0), _GREY]
    for start in range(0, len(payload), WIDTH * ROWS):
        part = payload[start : start + WIDTH * ROWS]
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, DELAY, 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0) + b"\x08" + _blocks(lzw_encode(part)))
    return b"".join(out) + b"\x3b"


def _levels(rgb: np.ndarray) -> np.ndarray:
    """The histogram's place of each colour: LEVELS levels of each channel."""
    level = rgb // np.uint8(256 // LEVELS)
    return (level[..., 0] * np.uint8(LEVELS) + level[..., 1]) * np.uint8(LEVELS) + level[..., 2]


def decode(data: bytes, max_pixels: int = MAX_PIXELS, rgb: bool = True) -> Iterator[dict]:
    """The frames of a GIF one by one, composed on its canvas under the disposal and transparency rules; no `canvas_rgb` unless `rgb`."""
    try:
        yield from _decode(data, max_pixels, rgb)
    except GifError:
        raise
    except (IndexError, ValueError, struct.error) as e:
        raise GifError(str(e)) from e


def _decode(data: bytes, max_pixels: int, rgb: bool) -> Iterator[dict]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise GifError("no GIF signature")
    canvas_w, canvas_h, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13

    def palette(has: int) -> np.ndarray | None:
        nonlocal at
        if not has & 0x80:
            return None
        n = 2 << (has & 7)
        colours = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
        return colours

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while size := data[at]:
            if at + 1 + size > len(data):
                raise GifError("a cut block")
            parts.append(data[at + 1 : at + 1 + size])
            at += 1 + size
        at += 1
        return b"".join(parts)

    if canvas_w * canvas_h > max_pixels:
        raise GifError(f"a canvas of more than {max_pixels} pixels")
    shared = palette(flags)
    # palette and indices of the last frame that covered the canvas, drawn only where its colours are wanted
    blank = np.zeros((1, 3), np.uint8), np.broadcast_to(np.uint8(0), (canvas_h, canvas_w))
    whole, canvas = blank, None
    delay, disposal, transparent, n = 0, 0, -1, 0
    while True:
        kind = data[at]
        at += 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label = data[at]
            at += 1
            body = blocks()
            if label == 0xF9 and len(body) >= 4:
                packed, delay, index = struct.unpack_from("<BHB", body)
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else -1
            continue
        if kind != 0x2C:
            raise GifError("an unknown block")
        left, top, w, h, local = struct.unpack_from("<HHHHB", data, at)
        at += 9
        if w * h > max_pixels:
            raise GifError(f"an image of more than {max_pixels} pixels")
        own = palette(local)
        colours = own if own is not None else shared
        if colours is None:
            raise GifError("no palette")
        bits = data[at]
        at += 1
        if not 2 <= bits <= 8:
            raise GifError("a bad code size")
        stream = blocks()
        raw = lzw_decode(stream, bits, w * h)
        if len(raw) < w * h:
            raise GifError("too few pixels")
        indices = np.frombuffer(raw, np.uint8).reshape(h, w)
        if local & 0x40:  # interlaced: rows come in four passes
            order = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
            straight = np.empty_like(indices)
            straight[order] = indices
            indices = straight
        before = (whole, None if canvas is None else canvas.copy()) if disposal == 3 else None
        rows, cols = min(h, max(0, canvas_h - top)), min(w, max(0, canvas_w - left))
        shown = indices[:rows, :cols]
        covers = transparent < 0 and not left and not top and w >= canvas_w and h >= canvas_h
        if covers:
            counts = np.bincount(shown.ravel(), minlength=256)
            if counts[len(colours) :].any():
                raise GifError("an index beyond the palette")
            whole, canvas = (colours, shown), None
            histogram = np.bincount(_levels(colours), counts[: len(colours)], LEVELS**3).astype(np.int64)
        else:
            opaque = shown != transparent
            if (shown[opaque] >= len(colours)).any():
                raise GifError("an index beyond the palette")
            if canvas is None:
                canvas = whole[0][whole[1]]
            region = canvas[top : top + rows, left : left + cols]
            region[opaque] = colours[shown[opaque]]
            histogram = np.bincount(_levels(canvas).ravel(), minlength=LEVELS**3)
        frame = {
            "frame": n, "left": left, "top": top, "width": w, "height": h, "delay_cs": delay, "disposal": disposal, "transparent": transparent,
            "indices": indices.tobytes(), "canvas_width": canvas_w, "canvas_height": canvas_h, "histogram": histogram,
        }
        if rgb:
            frame["canvas_rgb"] = (whole[0][whole[1]] if canvas is None else canvas).tobytes()
        yield frame
        if disposal == 2:
            if covers:
                whole = blank
            else:
                region[:] = 0
        elif disposal == 3:
            whole, canvas = before
        delay, disposal, transparent, n = 0, 0, -1, n + 1


def store(df: DataFrame, payload: str, out: str = "media") -> DataFrame:
    """df with the column `out`: the GIF of the binary column `payload`, whose length is a positive multiple of WIDTH; null stays null."""
    ship(df.sparkSession)

    @F.pandas_udf("binary")
    def stored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if p is None else encode_payload(bytes(p)) for p in batch], dtype=object)

    return df.withColumn(out, stored(F.col(payload)))


def frames(df: DataFrame, media: str, max_pixels: int = MAX_PIXELS) -> DataFrame:
    """One row per frame: the other columns of df and those of FRAME_SCHEMA (names that df has are replaced)."""
    ship(df.sparkSession)
    made = T._parse_datatype_string(FRAME_SCHEMA).fields
    names = [f.name for f in made]
    kept = [c for c in df.columns if c not in names and c != media]
    (raw,) = fresh(df, "_media")
    types = [pa.int32() if f.dataType == T.IntegerType() else pa.binary() if f.dataType == T.BinaryType() else pa.list_(pa.int32()) if f.name == "histogram" else pa.string() for f in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = [c.slice(i, 1) for c in batch.columns[:-1]]
                for row in _rows(batch.column(batch.num_columns - 1)[i].as_py() or b"", max_pixels):
                    yield pa.RecordBatch.from_arrays([*own, *[pa.array([row.get(n)], t) for n, t in zip(names, types)]], names=[*kept, *names])

    schema = T.StructType([*[df.schema[c] for c in kept], *made])
    return df.select(*kept, F.col(media).alias(raw)).mapInArrow(run, schema)


def _rows(data: bytes, max_pixels: int) -> Iterator[dict]:
    """The frames of a GIF, then a row with the fault if there is one."""
    try:
        for frame in decode(data, max_pixels):
            yield frame | {"histogram": frame["histogram"].tolist()}
    except GifError as e:
        yield {"error": str(e)}


LOADED = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames int, duration_cs int, histogram array<long>, "
    "frames array<struct<frame:int,start_cs:int,delay_cs:int,histogram:array<int>>>, error string"
)


def loaded(data: bytes | None, max_pixels: int = MAX_PIXELS) -> dict:
    """The fields of LOADED for one value."""
    if data is None:
        return {}
    digest, tail, size, time, tally, shown = hashlib.sha256(), b"", 0, 0, np.zeros(LEVELS**3, np.int64), []
    whole = {"media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
    try:
        for f in decode(data, max_pixels, rgb=False):
            body = f["indices"]
            digest.update(body)
            tail = (tail + body[-64:])[-64:]
            size += len(body)
            shown.append({"frame": f["frame"], "start_cs": time, "delay_cs": f["delay_cs"], "histogram": f["histogram"].tolist()})
            time += f["delay_cs"]
            tally += f["histogram"]
    except GifError as e:
        return whole | {"error": str(e)}
    return whole | {
        "payload_bytes": size, "payload_sha256": digest.hexdigest(), "tail_crc32": zlib.crc32(tail), "n_frames": len(shown), "duration_cs": time, "histogram": tally.tolist(), "frames": shown,
    }


def load(df: DataFrame, media: str, out: str = "loaded", max_pixels: int = MAX_PIXELS) -> DataFrame:
    """df with the struct `out` (LOADED): what the stored GIF decodes to, as sums over the whole media value and as a list of its timed frames.

    All frames of a media value, with 64 counts each, are one row: memory grows with the frames of one value (max_pixels bounds a frame).
    Digests and histograms leave the worker; the payload itself is the frames' `indices` in order.
    """
    ship(df.sparkSession)
    kind = T._parse_datatype_string(LOADED)

    @F.pandas_udf(kind)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [loaded(None if data is None else bytes(data), max_pixels) for data in batch]
            columns = {f.name: pd.Series([r.get(f.name) for r in rows], dtype="Int64" if f.dataType in (T.LongType(), T.IntegerType()) else object) for f in kind.fields}
            yield pd.DataFrame(columns)

    return df.withColumn(out, read(F.col(media)))
