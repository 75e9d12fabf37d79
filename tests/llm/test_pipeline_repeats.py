"""Repeated and null ids: one row of each group stays, and no row goes for its id alone."""

import corpus_pipeline


def words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_repeated_ids(spark):
    a, b, c, d, e = map(words, "abcde")
    rows = [
        (3, a), (5, a + " end"), (5, b), (5, e), (-7, c), (-7, c), (7, c), (None, a), (None, d), (None, d), (None, d + " end"), (8, ""), (8, ""), (None, None), (9, None), (None, e),
    ]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", len(t or "")) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, docs, "").select("doc_id", "text").collect()]
    null = [t for i, t in got if i is None and t]
    assert len(null) == 1 and null[0] in (d, d + " end")
    assert sorted((x for x in got if x[0] is not None or not x[1]), key=repr) == sorted([(3, a), (5, b), (5, e), (-7, c), (8, ""), (8, ""), (None, None), (9, None)], key=repr)
