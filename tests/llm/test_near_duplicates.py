import random
from itertools import combinations

import numpy as np
import pytest

from quern.llm import near_duplicates as nd


def brute(rows, words=5):
    """component and set size by row, over all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if rows[a][0] is not None and rows[b][0] is not None and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(sets[i]), least.get(find(i)) if k is not None else None) for i, (k, _) in enumerate(rows)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = nd.near_duplicates(df, "doc_id", "text").collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in out)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr)


def edited(r, words, n, tag):
    out = list(words)
    for i in r.sample(range(len(out)), n):
        out[i] = f"{tag}{r.randint(0, 9)}"
    return " ".join(out)


def test_groups_chains_and_hard_negatives(spark):
    """A crowd of edits of one text, of which some link to it, some to each other and some to none."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(r, base, r.randint(0, 7), "e")) for i in range(140)]
    chain = [f"c{i}" for i in range(200)]
    for step in range(12):  # each links to the next, the ends do not
        rows.append((500 + step, " ".join(chain)))
        chain = chain[3:] + [f"d{step}{j}" for j in range(3)]
    rows += [(900 + i, "same text again and again and again") for i in range(60)]
    rows += [(990, "Short Text"), (991, "short text"), (992, "short  text\n"), (993, "other text"), (994, None), (995, ""), (None, "short text"), (990, "something else entirely here now")]
    assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_table(spark, small):
    rows = [(int(i), t) for i, t in zip(small["doc_id"], small["text"])]
    assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_edges(edge, empty):
    out = nd.near_duplicates(edge, "doc_id", "text").collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"], r["kept"]) for r in out)
    assert len(out) == edge.count() and (4, 4, True) in got and (5, 4, False) in got and (-1, None, True) in got and got.count((3, 3, True)) == 2
    assert nd.near_duplicates(empty, "doc_id", "text").count() == 0


def test_sketch_estimates_similarity():
    r = np.random.default_rng(2)
    errors = []
    for _ in range(150):
        n, m = int(r.integers(1, 400)), int(r.integers(0, 400))
        shared, a, b = (r.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, m, m))
        sets = [np.unique(np.concatenate([shared, x])) for x in (a, b)]
        s = nd.sketch(sets, 125)
        assert (s != nd._EMPTY).all()  # every coordinate is filled
        errors.append((s[0] == s[1]).mean() - n / (n + 2 * m))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    alone = nd.sketch([np.array([7], np.uint64)], 125)
    assert (alone == nd.sketch([np.array([7], np.uint64), np.array([8], np.uint64)], 125)[0]).all()


def test_odd_sketch_is_a_bound():
    r = np.random.default_rng(3)
    for _ in range(100):
        a, b = (np.unique(r.integers(0, 1 << 63, int(r.integers(1, 3000)), dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([b, a[::3]]))
        x, y = nd.odd_sketch(a).view(np.uint64), nd.odd_sketch(b).view(np.uint64)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(1, 2), (2, 3), (5, 6), (3, 1)]])
def test_components(spark, edges):
    import hashlib

    name = lambda i: hashlib.md5(str(i).encode()).digest()
    nodes = spark.createDataFrame([(bytearray(name(i)),) for i in range(70)], "node binary")
    pairs = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in edges], "a binary, b binary")
    comp = {bytes(r["node"]): bytes(r["comp"]) for r in nd.components(nodes, pairs).collect()}
    parent = list(range(70))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for a, b in edges:
        parent[find(a)] = find(b)
    assert len(comp) == 70 and all((comp[name(a)] == comp[name(b)]) == (find(a) == find(b)) for a, b in combinations(range(70), 2))


def test_large_buckets(spark, monkeypatch):
    """Buckets of more members than a part holds: near copies in one class of buckets, and texts that share most words but no link."""
    monkeypatch.setattr(nd, "BLOCK", 4)
    r = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        t = base.copy()
        t[r.randrange(len(t))] = f"x{i}"
        rows.append((i, " ".join(t)))
    for i in range(60, 110):
        t = base[:95] + [f"y{i}_{j}" for j in range(r.choice([3, 12, 20, 25]))]
        rows.append((i, " ".join(t)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
    assert sorted((x["k"], x["n_shingles"], x["component_id"]) for x in got) == sorted(brute(rows))
