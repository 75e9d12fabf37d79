import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from quern.llm import packing

from .conftest import path

END, LIMIT = 2, 1024


def best_fit(sizes, limit):
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        gap = gaps.pop(i) if i < len(gaps) else limit
        n += gap == limit
        if gap > s:
            bisect.insort(gaps, gap - s)
    return n


def planned(spark, sizes, limit):
    """Sequences of the plan as lists of (offset, length), every piece checked to be placed once."""
    counts = spark.createDataFrame(sorted(Counter(sizes).items()), "length long, n long")
    seqs, seen = defaultdict(list), defaultdict(list)
    for r in packing.plan(counts, limit).collect():
        for k in range(r["lo"], r["hi"]):
            seqs[r["first"] + (k - r["lo"]) // r["per"]].append((r["at"] + (k - r["lo"]) % r["per"] * r["length"], r["length"]))
            seen[r["length"]].append(k)
    assert {n: sorted(k) for n, k in seen.items()} == {n: list(range(k)) for n, k in Counter(sizes).items()}
    for parts in seqs.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= limit
    return seqs


def close(n, sizes, limit):
    """Within one sequence and one per cent of best-fit decreasing."""
    best = best_fit(sizes, limit)
    return n <= best + max(1, best // 100)


def test_plan(spark):
    r = random.Random(1)
    for turn in range(8):
        limit = r.choice([16, 64, 1024])
        sizes = [r.randint(1, limit) for _ in range(r.randint(0, 300))] + [r.randint(1, max(1, limit // 7))] * (r.randint(0, 500) if turn % 3 == 0 else 0)
        seqs = planned(spark, sizes, limit)
        assert len(seqs) <= best_fit(sizes, limit) + max(2, len(seqs) // 25), (turn, limit)
    assert planned(spark, [], 16) == {}
    assert len(planned(spark, [1] * 100, 1)) == 100 and len(planned(spark, [5] * 1000, 1024)) == 5
    assert len(planned(spark, [600] * 50 + [424] * 50, 1024)) == 50 and len(planned(spark, [1024] * 7 + [3], 1024)) == 8


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(1025, 1024) == [(0, 1), (1, 1024)] and packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_encoder_gives_the_librarys_ids(small):
    from tokenizers import Tokenizer

    texts = small["text"].tolist() + ["", "<|endoftext|>a", "it's  \n\n a　b", "नमस्ते दुनिया", "\x1c a", "a b", "­", "  ", "é\x85x", "a \nb", "a b ", "don't 's x's", "\n\n a", " a", "12½ ²3x", "a\t b", "x" * 5000]
    library = Tokenizer.from_file(path("byte_bpe_50k.json")).encode_batch(texts, add_special_tokens=False)
    assert packing.PieceEncoder(path("byte_bpe_50k.json")).encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in library]


def check(df, out):
    from tokenizers import Tokenizer

    rows = out.collect()
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    whole = Counter()
    want = [(r["doc_id"], np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [END], "<u4").tobytes()) for r in df.collect()]
    for key, ids in want:
        for n, (start, length) in enumerate(packing.cut(len(ids) // 4, LIMIT)):
            whole[key, n, start, length, ids[4 * start : 4 * (start + length)]] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == whole
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= LIMIT
    assert close(len(seqs), [r["length"] for r in rows], LIMIT)


def test_documents(spark, small):
    df = spark.createDataFrame(small[["doc_id", "text"]])
    check(df, packing.pack(df, "doc_id", "text", path("byte_bpe_50k.json"), END, LIMIT))


def test_edges(edge, empty):
    check(edge, packing.pack(edge, "doc_id", "text", path("byte_bpe_50k.json"), END, LIMIT))
    assert packing.pack(empty, "doc_id", "text", path("byte_bpe_50k.json"), END, LIMIT).count() == 0
