import numpy as np

from quern.llm import queries, sentence_pieces, token_count

from .conftest import path

MODEL = "piece_bpe_32k.model"
ODD = ["", "a", " a", "a  b ", "\n", "  ", "ﬁ é", "a\tb", "<s>x</s>", "▁a b", "a\x00b", "x　y", "नमस्ते दुनिया", "𝔘𝔫i", "<0x41>", "日本語 テキスト"]


def brute(codec, pieces, s):
    """Best sum of scores over all segmentations, by plain dynamic programming."""
    best = [0.0] + [float("-inf")] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(end):
            if s[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[s[start:end]])
        if s[end - 1] not in codec.single:
            best[end] = max(best[end], best[end - 1] + codec.penalty)
    return best[-1]


def test_viterbi_and_round_trip(small):
    codec = sentence_pieces.codec(path(MODEL))
    pieces = {t: codec.scores[i] for i, t in enumerate(codec.text) if not codec.special[i]}
    for t in [x[:400] for x in small["text"][:60]] + ODD:
        ids = np.frombuffer(codec.encode(t), np.int32)
        s = "▁" + t.replace(" ", "▁") if t else ""
        assert codec.scores[ids].sum() == brute(codec, pieces, s)
        assert codec.decode(ids) == t.replace("▁", " ")


def test_against_the_librarys_unigram_search(small):
    """The same pieces and scores as a unigram model: never worse than the library, which rounds sums to 32 bits."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path(MODEL), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    codec = sentence_pieces.codec(path(MODEL))
    words = {w for t in small["text"] for w in t.split()} | set(ODD)
    same = 0
    for w in words:
        own, other = np.frombuffer(codec.encode(w), np.int32), library.encode(w)
        assert codec.scores[own].sum() >= codec.scores[other].sum() - 1e-6
        same += own.tolist() == other
    assert same > 0.9 * len(words)


def test_frames(spark, edge, empty):
    out = sentence_pieces.encode(edge, "doc_id", "text", path(MODEL))
    rows = sentence_pieces.decode(out, "ids", path(MODEL)).collect()
    assert len(rows) == edge.count() and all(r["decoded"] == (r["text"] or "").replace("▁", " ") for r in rows)
    assert sentence_pieces.encode(empty, "doc_id", "text", path(MODEL)).count() == 0
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in sentence_pieces.decode(none, "ids", path(MODEL)).collect()] == [None, ""]


def test_query(spark):
    out = queries.op3_sentence_pieces(spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.where("NOT round_trip").count() == 0


def test_counts_are_the_librarys(spark, small, edge, empty):
    sp = token_count.model(path(MODEL))
    df = spark.createDataFrame(small[["doc_id", "text"]])
    for rows in (df, edge, spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")):
        got = token_count.count_tokens(rows, "text", path(MODEL)).collect()
        assert all(r["n_tokens"] == len(sp.encode(r["text"] or "")) for r in got)
    assert token_count.count_tokens(empty, "text", path(MODEL)).count() == 0


def test_no_tier_changes_a_count(spark, small, monkeypatch):
    monkeypatch.setattr(token_count, "CACHE_ENTRIES", 10)
    texts = small["text"].tolist()
    lengths = token_count.Lengths(path(MODEL), {"the": 1})
    sp = token_count.model(path(MODEL))
    assert [sum(map(lengths.__getitem__, token_count.pretokens(t))) for t in texts[:50]] == [len(sp.encode(t)) for t in texts[:50]]
    table = {"": 1, "the": 1, "ü日": 4}
    assert token_count.unpack_table(token_count.pack_table(table)) == table
    df = spark.createDataFrame(small[["doc_id", "text"]])
    for entries, rows in ((0, 0), (5, 10)):
        got = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(df, "text", path(MODEL), entries=entries, sample_rows=rows).collect()}
        assert got == {i: len(sp.encode(t)) for i, t in zip(small["doc_id"], texts)}
