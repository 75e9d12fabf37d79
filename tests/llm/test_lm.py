import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quern.llm import ngram_lm, queries

DATA = "/root/testdata/sf0.001"


def tokens(t):
    return (t or "").encode().lower().split() + [None]


class Brute:
    """The model by dictionaries."""

    def __init__(self, texts):
        seqs = [tokens(t) for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter((v, w) for s in seqs for v, w in zip(["begin", *s], s))
        self.context, self.follows = defaultdict(lambda: [0, 0, 0, 0]), Counter()
        for (v, w), k in self.pairs.items():
            self.context[v][0] += k
            self.context[v][min(k, 3)] += 1
            self.follows[w] += 1
        of = lambda values: ngram_lm.discounts(*(sum(x == k for x in values) for k in (1, 2, 3, 4)))
        self.d2, self.d1 = of(list(self.pairs.values())), of(list(self.follows.values()))
        self.t = sum(self.follows.values())
        self.w1 = sum(self.d1[min(x, 3)] for x in self.follows.values()) / self.t if self.t else 1.0

    def lower(self, w):
        k = self.follows.get(w, 0)
        return max(k - self.d1[min(k, 3)], 0) / max(1, self.t) + self.w1 / (self.v + 1)

    def p(self, w, v):
        if v not in self.context:
            return self.lower(w)
        total, *tally = self.context[v]
        k = self.pairs.get((v, w), 0)
        return max(k - self.d2[min(k, 3)], 0) / total + sum(d * n for d, n in zip(self.d2[1:], tally)) / total * self.lower(w)

    def score(self, t):
        s = tokens(t)
        base = sum(math.log10((self.c.get(w, 0) + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in s)
        return len(s), sum(w in self.c for w in s), base, sum(math.log10(self.p(w, v)) for v, w in zip(["begin", *s], s))


def compare(rows, texts, model):
    for r, t in zip(rows, texts):
        want = model.score(t)
        assert (r["n_tokens"], r["n_known"]) == want[:2]
        assert r["base_score"] == pytest.approx(want[2], rel=1e-9, abs=1e-6) and r["score"] == pytest.approx(want[3], rel=1e-9, abs=1e-6)


def test_query_against_brute_force(spark, small, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BUCKET_BYTES", 50_000)  # several buckets
    monkeypatch.setattr(ngram_lm, "WORD_BUCKET_BYTES", 100_000)
    rows = {r["doc_id"]: r for r in queries.op5_kneser_ney(spark, DATA).collect()}
    out = [zlib.crc32(str(i).encode()) % 10 == 0 for i in small["doc_id"]]
    model = Brute([t for t, o in zip(small["text"], out) if not o])
    compare([rows[i] for i in small["doc_id"]], small["text"], model)
    assert all(rows[i]["held_out"] == o and rows[i]["train_tokens"] == model.n for i, o in zip(small["doc_id"], out))
    words = [*list(model.c)[:400], b"never seen"]
    for v in ("begin", words[3], b"never seen"):
        assert sum(model.p(w, v) for w in model.c) + model.p(b"never seen", v) == pytest.approx(1.0)
    assert words


def test_edges(spark, edge, empty):
    texts = [r["text"] for r in edge.collect()]
    model = ngram_lm.train(edge, "text")
    got = ngram_lm.score(edge, "doc_id", "text", model).collect()
    brute = Brute(texts)
    key = lambda r: (r["n_tokens"], r["n_known"], round(r["score"], 6))
    assert sorted(map(key, got)) == sorted((a, b, round(d, 6)) for a, b, _, d in map(brute.score, texts))
    assert ngram_lm.score(empty, "doc_id", "text", model).count() == 0
    none = ngram_lm.train(empty, "text")
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in ngram_lm.score(edge, "doc_id", "text", none).collect())


@pytest.mark.parametrize("buckets", [1, 2, 64, 1 << 20])
def test_pairs_come_back(buckets):
    """Numbers beyond 32 bits too, and a frequent context or word is spread."""
    r = np.random.default_rng(3)
    most = min(1 << 40, buckets << 24)
    v, w = r.integers(0, 1 << 40, 5000), r.integers(0, most, 5000)
    v[:1000], w[1000:2000] = 7, 5
    bucket, keys = ngram_lm.pair_place(v, w, buckets)
    for b, k, x, y in zip(bucket[::50], keys[::50], v[::50], w[::50]):
        one, two = ngram_lm.pair_of(int(b), np.array([k]), buckets)
        assert (one[0], two[0]) == (x, y)
    if buckets == 64:
        assert max(np.bincount(bucket[:1000], minlength=64).max(), np.bincount(bucket[1000:2000], minlength=64).max()) < 60


def test_runs_round_trip():
    r = np.random.default_rng(1)
    for high in (5, 1 << 20, (1 << 64) - 1):
        keys = np.unique(r.integers(0, high, 200, dtype=np.uint64, endpoint=True))
        counts = r.integers(1, 70_000, len(keys))
        _, n, first, width, steps, kind, raw = ngram_lm.pack_run(0, keys, counts)
        k, c = ngram_lm.unpack_run(n, first, width, steps, kind, raw)
        assert (k == keys).all() and (c == counts).all()
