import math
import random

import pytest
from pyspark.sql import functions as F

from quern.llm import top_k


def brute(rows, k, limit=1 << 63):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-max(-limit, min(limit - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in good if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit("x"), "rank": F.lit(1), "q": F.lit(2)}).repartition(5)
    out = top_k.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k, **more)
    return sorted(tuple(r) for r in out.select("query", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("more", [{}, {"parts": 1}, {"block_bytes": 150}])
def test_against_brute_force(spark, more):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(9)]) for i in range(260)]
    assert run(spark, rows, **more) == brute(rows, 5)


def test_ties_and_a_hot_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(i, [0.5, 0.5, -0.5]) for i in range(300, 330)]
    assert run(spark, rows) == brute(rows, 5)


def test_negative_scores_and_few_rows(spark):
    rows = [(0, [1.0, 1.0]), (1, [-1.0, -2.0]), (2, [-3.0, -0.1]), (50, [-1.0, -1.0])]
    assert run(spark, rows) == brute(rows, 5)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (None, [9.0, 9.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, [3.0]), (6, [1.0, 1.0]), (50, [0.0, 0.0]), (7, []), (8, [1e30, 1e30]), (100, [1e6, -1e30])]
    assert run(spark, rows) == brute([(i, v and v + [0.0] * (2 - len(v))) if v != [] else (i, [0.0, 0.0]) for i, v in rows], 5)
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == [] and run(spark, [(0, [1.0])]) == []


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0])]
    assert [r[2] for r in run(spark, rows, 3)] == [7, 7, 8]
