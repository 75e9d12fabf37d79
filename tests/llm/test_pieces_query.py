"""op3's query on whole texts against a search that knows neither automaton nor cache."""

import sentencepiece

from quern.llm import queries

from .conftest import path

UNKNOWN = -10.0


def best_path(text, pieces, longest, byte, least):
    """Ids and score of the best path by relaxing every piece that begins at every position; the longer piece wins ties."""
    s = "▁" + text.replace(" ", "▁") if text else ""
    score, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - longest), end):
            found = pieces.get(s[start:end])
            if found and (score[end] is None or score[start] + found[1] > score[end]):
                score[end], back[end] = score[start] + found[1], (start, [found[0]])
        if s[end - 1] not in pieces and (score[end] is None or score[end - 1] + least + UNKNOWN > score[end]):
            score[end], back[end] = score[end - 1] + least + UNKNOWN, (end - 1, [byte[b] for b in s[end - 1].encode()])
    ids, at = [], len(s)
    while at:
        at, own = back[at]
        ids[:0] = own
    return ids, score[-1] or 0.0


def test_ids_and_scores_of_whole_texts(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain}
    byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    least, longest = min(s for _, s in pieces.values()), max(map(len, pieces))
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.op3_sentence_pieces(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for key, text in rows.items():
        ids, score = best_path(text, pieces, longest, byte, least)
        assert got[key]["ids"] == ids and got[key]["n_ids"] == len(ids), key
        assert abs(got[key]["score"] - score) < 1e-6 * max(1.0, abs(score)) and got[key]["round_trip"]
