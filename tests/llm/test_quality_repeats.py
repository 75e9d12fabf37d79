import hashlib

import numpy as np

from quern.llm import quality


def test_one_row_per_labelled_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, grades, *_: seen.append((rows, grades.tolist())))
    texts = [f"hot text number {i}" for i in range(50)]
    docs = spark.createDataFrame([(1, t) for t in texts] + [(2, "two"), (3, None), (3, None), (4, "not rated")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "doc_id long, grade int")
    quality.train(docs, labels, "doc_id", "text", "grade", 3)
    rows, grades = seen[0]
    assert sorted(grades) == [0, 1, 2]
    least = min(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    want = np.unique(np.array([quality.slot(t, 1 << 18) for t in quality.tokens(least)], np.int32))
    assert rows[grades.index(2)].tolist() == want.tolist()
