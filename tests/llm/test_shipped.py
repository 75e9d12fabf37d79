"""Called as a library from another folder, the operators give their workers the package themselves."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import public_tokenizers
from quern.llm import cross_tokenizer, gif_media, hard_negatives, near_duplicates, ngram_lm, packing, quality, sentence_pieces, token_count, top_k
docs = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id long, text string")
a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "packing": lambda: packing.pieces(docs, "doc_id", "text", a, 2, 16),
    "pieces": lambda: sentence_pieces.encode(docs, "doc_id", "text", b),
    "counts": lambda: token_count.count_tokens(docs, "text", b),
    "gif": lambda: gif_media.load(gif_media.store(docs.select(F.lit("x" * 64).cast("binary").alias("p")), "p"), "media"),
    "quality": lambda: quality.score(docs, "text", quality.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, grade int"), "doc_id", "text", "grade", 2), 2, 1, 0.5),
    "features": lambda: near_duplicates.features(docs, "doc_id", "text", 5, 2, 2),
    "lm": lambda: ngram_lm.score(docs, "doc_id", "text", ngram_lm.train(docs, "text")),
    "align": lambda: cross_tokenizer.align(docs, "doc_id", "text", a, b),
    "top_k": lambda: top_k.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "i long, v array<double>"), "i", "v", F.col("i") == 0, 1),
    "negatives": lambda: hard_negatives.mine(spark.createDataFrame([(0, 1, [1.0]), (1, 1, [2.0]), (2, 2, [1.9])], "i long, y int, v array<double>"), "i", "y", "v", F.col("i") == 0),
}
OPERATORS[sys.argv[2]]().collect()
print("done")
"""


def test_operators_ship_themselves(tmp_path):
    """One after the other in processes of their own, as a shipped package stays."""
    root = str(Path(__file__).resolve().parents[2])
    (tmp_path / "script.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = ["packing", "pieces", "counts", "gif", "quality", "features", "lm", "align", "top_k", "negatives"]
    for at in range(0, len(names), 3):  # three at a time
        runs = [subprocess.Popen([sys.executable, "script.py", root, n], cwd=tmp_path, env=env, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True) for n in names[at : at + 3]]
        for name, run in zip(names[at:], runs):
            out, err = run.communicate(timeout=600)
            assert "done" in out, (name, err[-2000:])
