import hashlib
import random
import struct
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import gif_media as gif
from quern.llm import queries

PALETTE = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])


def slow_lzw(data, bits):
    """A plain encoder with a clear code whenever it likes: written for the test."""
    clear, end = 1 << bits, (1 << bits) + 1
    out, acc, n = bytearray(), 0, 0

    def put(code, width):
        nonlocal acc, n
        acc |= code << n
        n += width
        while n >= 8:
            out.append(acc & 255)
            acc >>= 8
            n -= 8

    put(clear, bits + 1)
    table, width, prefix = {bytes([i]): i for i in range(clear)}, bits + 1, b""
    nxt = clear + 2
    for b in data:
        if prefix + bytes([b]) in table:
            prefix += bytes([b])
            continue
        put(table[prefix], width)
        if nxt < 4096:  # a full table stays: the deferred clear
            table[prefix + bytes([b])] = nxt
            nxt += 1
            if nxt - 1 == 1 << width and width < 12:
                width += 1
        prefix = bytes([b])
    if prefix:
        put(table[prefix], width)
    put(end, 12 if nxt >= 4096 else width if nxt < 1 << width else min(12, width + (nxt == 1 << width and width < 12)))
    if n:
        out.append(acc & 255)
    return bytes(out)


def image(left, top, w, h, pixels, flags=0, bits=2):
    body = gif.lzw_encode(bytes(pixels), bits)
    return b"\x2c" + struct.pack("<HHHHB", left, top, w, h, flags) + bytes([bits]) + gif._blocks(body)


def control(disposal, delay, transparent=None):
    return b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\0"


def movie(*parts, w=2, h=2):
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0x81, 0, 0) + PALETTE + b"".join(parts) + b"\x3b"


def frames_of(data):
    return list(gif.decode(data))


def plain_decoder(data):
    """Delays and pixels of a GIF of whole, opaque frames, bit by bit: written for the test, knows nothing of the operator."""
    at = 13 + 3 * (2 << (data[10] & 7))
    palette, delay, out = data[13:at], 0, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                delay = int.from_bytes(data[at + 4 : at + 6], "little")
            at += 2
        else:
            bits, at = data[at + 10], at + 11
        stream, image = b"", data[at - 11] == 0x2C if data[at - 2] != 0x21 else False
        while data[at]:
            stream += data[at + 1 : at + 1 + data[at]]
            at += 1 + data[at]
        at += 1
        if not image:
            continue
        number, place = int.from_bytes(stream, "little"), 0
        clear, pixels, table, last = 1 << bits, bytearray(), [], None
        width = bits + 1
        while True:
            code = number >> place & ((1 << width) - 1)
            place += width
            if place % 4096 < width:  # keep the number short
                number >>= place
                place = 0
            if code == clear:
                table, width, last = [bytes([i]) for i in range(clear)] + [b"", b""], bits + 1, None
                continue
            if code == clear + 1:
                break
            entry = table[code] if code < len(table) else last + last[:1]
            if last is not None and len(table) < 4096:
                table.append(last + entry[:1])
                if len(table) == 1 << width and width < 12:
                    width += 1
            pixels += entry
            last = entry
        out.append((delay, bytes(pixels), [tuple(palette[3 * p : 3 * p + 3]) for p in range(256)]))
    return out


def plain_histogram(pixels, palette):
    """Pixels by four levels of each channel, counted one by one."""
    counts = [0] * 64
    for p in pixels:
        r, g, b = palette[p]
        counts[r // 64 * 16 + g // 64 * 4 + b // 64] += 1
    return counts


def canvas(frame):
    colours = {PALETTE[3 * i : 3 * i + 3]: i for i in range(4)}
    rgb = frame["canvas_rgb"]
    return [colours[rgb[i : i + 3]] for i in range(0, len(rgb), 3)]


@pytest.mark.parametrize("size", [1, 2, 64, 3837, 3838, 3839, 3840, 3841, 20_000])
def test_lzw_round_trip(size):
    r = random.Random(size)
    for data in (bytes(size), r.randbytes(size), bytes(r.choice(b"ab ") for _ in range(size))):
        assert gif.lzw_decode(gif.lzw_encode(data), 8, size) == data
    for bits in (2, 3, 5, 8):
        data = bytes(r.randrange(1 << bits) for _ in range(size))
        assert gif.lzw_decode(gif.lzw_encode(data, bits), bits, size) == data


def test_deferred_clear():
    r = random.Random(9)
    data = r.randbytes(9000)
    assert gif.lzw_decode(slow_lzw(data, 8), 8, 9000) == data


def test_disposal_and_transparency():
    base = control(1, 5) + image(0, 0, 2, 2, [1, 1, 1, 1])
    kept = frames_of(movie(base, control(1, 6, 0) + image(0, 0, 2, 1, [0, 2])))
    assert [canvas(f) for f in kept] == [[1, 1, 1, 1], [1, 2, 1, 1]] and [f["delay_cs"] for f in kept] == [5, 6]
    cleared = frames_of(movie(base, control(2, 6) + image(0, 0, 2, 1, [2, 2]), control(0, 1) + image(1, 1, 1, 1, [3])))
    assert [canvas(f) for f in cleared] == [[1, 1, 1, 1], [2, 2, 1, 1], [0, 0, 1, 3]]
    restored = frames_of(movie(base, control(3, 6) + image(0, 0, 2, 1, [2, 2]), image(1, 1, 1, 1, [3])))
    assert canvas(restored[2]) == [1, 1, 1, 3] and restored[2]["delay_cs"] == 0


def test_interlace_and_local_palette():
    rows = [i % 4 for i in range(10)]
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7, 9]
    frame = frames_of(movie(image(0, 0, 1, 10, [rows[i] for i in order], flags=0x40), w=1, h=10))[0]
    assert list(frame["indices"]) == rows
    local = b"\x2c" + struct.pack("<HHHHB", 0, 0, 2, 2, 0x81) + PALETTE[::-1] + b"\x02" + gif._blocks(gif.lzw_encode(bytes([0, 1, 2, 3]), 2))
    assert frames_of(movie(local))[0]["canvas_rgb"] == PALETTE[::-1]
    assert sum(frames_of(movie(local))[0]["histogram"]) == 4


@pytest.mark.parametrize("size", [64, 128, gif.WIDTH * gif.ROWS, gif.WIDTH * gif.ROWS + 64])
def test_payload_round_trip(size):
    payload = random.Random(size).randbytes(size)
    frames = frames_of(gif.encode_payload(payload))
    assert b"".join(f["indices"] for f in frames) == payload and len(frames) == -(-size // (gif.WIDTH * gif.ROWS))
    with pytest.raises(ValueError):
        gif.encode_payload(payload + b"x")


def test_broken(spark):
    good = gif.encode_payload(bytes(64))
    for cut in range(len(good) - 1):
        with pytest.raises(gif.GifError):
            frames_of(good[:cut])
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(good[:-9])), (3, None), (4, bytearray(b""))], "k int, media binary").withColumn("frame", F.lit("clash"))
    rows = {r["k"]: r for r in gif.frames(df, "media").collect()}
    assert rows[1]["error"] is None and rows[1]["frame"] == 0 and sum(rows[1]["histogram"]) == 64
    assert all(rows[k]["error"] and rows[k]["frame"] is None for k in (2, 3, 4))
    assert gif.frames(df.limit(0), "media").count() == 0


def test_load_never_fails(spark):
    good = gif.encode_payload(bytes(range(64)))
    huge = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x3b"
    wide = movie(b"\x2c" + struct.pack("<HHHHB", 0, 0, 65535, 65535, 0) + b"\x02" + gif._blocks(gif.lzw_encode(bytes(4), 2)))
    two = movie(control(0, 5) + image(0, 0, 2, 2, [1, 1, 2, 3]), control(0, 7) + image(0, 0, 2, 2, [1, 1, 2, 3]))
    values = [good, good[:-9], None, b"", huge, wide, two[:-12], b"GIF89a", good]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "k int, media binary")
    rows = [r["loaded"] for r in gif.load(df, "media").orderBy("k").collect()]
    assert rows[0]["error"] is None and rows[0] == rows[8] and rows[0]["payload_sha256"] == hashlib.sha256(bytes(range(64))).hexdigest()
    assert rows[2]["error"] is None and rows[2]["media_bytes"] is None and rows[2]["frames"] is None
    for i in (1, 3, 4, 5, 6, 7):
        assert rows[i]["error"] and rows[i]["payload_sha256"] is None and rows[i]["media_bytes"] == len(values[i]), i
    assert "canvas" in rows[4]["error"] and "image" in rows[5]["error"]
    shown = gif.frames(df.where("k = 6"), "media").collect()
    assert [(r["frame"], r["delay_cs"], r["error"] is None) for r in shown] == [(0, 5, True), (None, None, False)]
    small = gif.load(df.where("k = 0"), "media", max_pixels=63).first()["loaded"]
    assert "63 pixels" in small["error"]


def test_query(spark, small):
    import zlib

    rows = {r["doc_id"]: r for r in queries.op10_gif_media(spark, "/root/testdata/sf0.001").collect()}
    for i, t in zip(small["doc_id"], small["text"]):
        raw = t.encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        media = gif.encode_payload(padded)
        r = rows[i]
        shown = plain_decoder(media)
        assert b"".join(pixels for _, pixels, _ in shown) == padded
        tallies = [plain_histogram(pixels, palette) for _, pixels, palette in shown]
        assert [(f["frame"], f["start_cs"], f["delay_cs"], f["histogram"]) for f in r["frames"]] == [(n, 10 * n, delay, tally) for n, ((delay, _, _), tally) in enumerate(zip(shown, tallies))]
        assert r["feature"] == f"{len(shown)}|{sum(d for d, _, _ in shown)}|" + ",".join(str(sum(x)) for x in zip(*tallies))
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(padded), len(media))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["media_sha256"] == hashlib.sha256(media).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-64:])


def test_edges(edge, empty):
    n = F.octet_length(F.coalesce("text", F.lit("")))
    pad = lambda df: df.withColumn("p", F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit("\0"), (F.greatest(F.lit(64), F.ceil(n / 64) * 64) - n).cast("int"))).cast("binary"))
    out = gif.load(gif.store(pad(edge), "p"), "media").select("text", "loaded.*").collect()
    assert len(out) == edge.count() and all(r["payload_bytes"] >= 64 for r in out)
    assert gif.load(gif.store(pad(empty), "p"), "media").count() == 0
    assert np.sum([r["n_frames"] > 1 for r in out]) >= 2


def lines_run(f):
    """What f returns, and how many lines of the operator ran for it: its work in Python, whatever the machine."""
    count, before = 0, sys.gettrace()

    def trace(frame, event, _):
        nonlocal count
        if frame.f_code.co_filename != gif.__file__:
            return None
        count += event == "line"
        return trace

    sys.settrace(trace)
    try:
        return f(), count
    finally:
        sys.settrace(before)


def test_work_per_byte():
    r = random.Random(4)
    words = ["".join(r.choices("etaoinshr", k=r.randint(2, 9))) for _ in range(400)]
    payload = " ".join(r.choices(words, k=9000)).encode()[: 500 * gif.WIDTH]
    media, writing = lines_run(lambda: gif.encode_payload(payload))
    # 5 lines a byte that goes on with a code, 6 where a code ends
    assert writing < 6 * len(payload) + 2000
    read, reading = lines_run(lambda: gif.loaded(media))
    # pixels and codes are arrays: lines are run per block and table only
    assert reading < len(media) // 255 * 10 + 2000 and reading < 0.2 * len(payload)
    assert read["payload_sha256"] == hashlib.sha256(payload).hexdigest() and sum(read["histogram"]) == len(payload)


@pytest.mark.parametrize(
    "payload, digest",
    [(bytes(64), "53bc8cb2f17340d45c74698527c65bd9cd6083874b3b672db0b7c09cea6b491c"), (bytes(range(256)) * 1200, "25deedef61a6fa4facf2465d03998c16394f9a0fbae30f0b711f93f728abcfec"), (b"a rose is a rose is a rose. " * 16_000, "b029d6701379bcf1ebc0cc05d3bf4de96c0255aa64413853127808bc1fac7478")],
    ids=["zeros", "ramp", "words"],
)
def test_stored_form_stays(payload, digest):
    assert hashlib.sha256(gif.encode_payload(payload)).hexdigest() == digest


def test_partial_frames_over_a_covering_one():
    cover = control(1, 0) + image(0, 0, 2, 2, [1, 2, 3, 1])
    for disposal, then in ((1, [3, 2, 3, 2]), (2, [0, 2, 3, 2]), (3, [1, 2, 3, 2])):
        shown = frames_of(movie(cover, control(disposal, 0) + image(0, 0, 1, 1, [3]), image(1, 1, 1, 1, [2])))
        assert [canvas(f) for f in shown] == [[1, 2, 3, 1], [3, 2, 3, 1], then]
    for disposal, then in ((1, [1, 2, 3, 2]), (2, [0, 0, 0, 2]), (3, [2, 2, 2, 2])):
        under = control(1, 0) + image(0, 0, 2, 2, [2, 2, 2, 2])
        media = movie(under, control(disposal, 0) + image(0, 0, 2, 2, [1, 2, 3, 1]), image(1, 1, 1, 1, [2]))
        assert canvas(frames_of(media)[2]) == then
        assert [f["histogram"].tolist() for f in frames_of(media)] == [f["histogram"].tolist() for f in gif.decode(media, rgb=False)]
        assert all(sum(f["histogram"]) == 4 and np.count_nonzero(f["histogram"]) == len(set(canvas(f))) for f in frames_of(media))
