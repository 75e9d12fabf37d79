"""A bucket with very many near copies and a few others makes few rows more than it has members."""

import random

from quern.llm import near_duplicates


def test_a_crowd_and_an_outsider(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    r = random.Random(6)
    words = [f"w{i}" for i in range(120)]
    near = lambda n: [(i, " ".join(w if r.random() > 0.004 else f"x{r.randrange(99)}" for w in words)) for i in range(n)]
    half = [(900 + i, " ".join(words[:70] + [f"y{i}{j}" for j in range(50 - 8 * i)])) for i in range(3)]
    rows = near(400) + half + [(None, "w1 w2"), (None, None), (7000, None), (7000, ""), (7001, " ")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = near_duplicates.near_duplicates(df, "doc_id", "text").collect()
    assert len(got) == len(rows) and all(x["component_id"] == x["doc_id"] and x["kept"] for x in got if x["n_shingles"] == 0 or x["doc_id"] is None)
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows if i is not None and t and len(t) > 2}
    reach = {i: i for i in sets}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and root(a) != root(b):
                reach[max(root(a), root(b))] = min(root(a), root(b))
    want = {i: root(i) for i in sets}
    assert {x["doc_id"]: x["component_id"] for x in got if x["doc_id"] in sets} == want and len(set(want.values())) > 1
