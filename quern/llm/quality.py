"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed features of the text is shared by all grades; ordered thresholds cut its
score: P(grade <= k) = sigmoid(threshold_k - score). That gives the expected grade and, for selection,
the tail probability P(grade >= k).

Features are present or absent: words, beginnings of longer words, runs of symbols, and levels of shape
(capitals, symbols, repeated words and lines, length). They are hashed into `buckets` weights.

The fit takes at most `max_labelled` labelled rows (those with the least hash of their id; a documented
bound). Scoring covers every row and whole texts, of any length. Null texts count as empty; null ids are
scored too; repeated rows score alike; an empty table stays empty; `scored` keeps every column of docs. Labels with a null id or grade are ignored, an id rated more than once counts
with its least grade. Without any label the scores are null and everything is kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, ship, trim

#: Entries of a worker's cache of weights; it starts anew beyond that.
CACHE_ENTRIES = 150_000
#: Labelled rows that a step of the fit holds at once.
BLOCK_ROWS = 1024
_TOKENS = re.compile(r"\w+|[^\w\s]+")


def _level(part: float) -> int:
    return int(part * 8 + 0.5)


def tokens(text: str) -> set[str]:
    """The features of a text."""
    found = _TOKENS.findall(text)
    words = [w.lower() for w in found if w[0].isalnum()]
    out = set(words)
    out.update(["^" + w[:5] for w in out if len(w) > 5])
    out.update(w for w in found if not w[0].isalnum())
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(text))
    out.add(f"\tcapital {_level(sum(map(str.isupper, text)) / n)}")
    out.add(f"\tsymbol {_level(2 * sum(len(w) for w in found if not w[0].isalnum()) / n)}")
    out.add(f"\trepeated {_level(1 - len(set(words)) / max(1, len(words)))} {min(4, len(words).bit_length() // 2)}")
    out.add(f"\tlines {_level(1 - len(set(lines)) / max(1, len(lines)))}")
    return out


def slot(token: str, buckets: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % buckets


@dataclass(frozen=True)
class Model:
    """Weights by bucket and increasing thresholds (grades - 1 of them)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, buckets: int, steps: int = 300, rate: float = 0.1, ridge: float = 1e-6, lasso: float = 3e-4) -> Model:
    """Maximum likelihood with ridge and lasso penalties, by Adam over all rows; rows hold the buckets of each text."""
    sizes = np.array([len(r) for r in rows])
    n, w = len(rows), np.zeros(buckets)
    # rows in blocks, so that a step's memory is that of a block
    blocks = [(slice(i, i + BLOCK_ROWS), np.concatenate(rows[i : i + BLOCK_ROWS]), sizes[i : i + BLOCK_ROWS]) for i in range(0, n, BLOCK_ROWS)]
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n, 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    # the first threshold and the logarithms of the steps between thresholds
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.05))])
    first, second = [np.zeros(buckets), np.zeros(len(free))], [np.zeros(buckets), np.zeros(len(free))]
    for step in range(1, steps + 1):
        score = np.concatenate([np.add.reduceat(w[at], np.cumsum(size) - size) for _, at, size in blocks])
        cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -60, 60))), np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        row = np.arange(n)
        p = np.maximum(below[row, grades + 1] - below[row, grades], 1e-12)
        by_score = (slope[row, grades + 1] - slope[row, grades]) / p / n
        by_cut = np.zeros(n_grades + 1)
        np.subtract.at(by_cut, grades + 1, slope[row, grades + 1] / p / n)
        np.add.at(by_cut, grades, slope[row, grades] / p / n)
        by_cut = by_cut[1:-1]
        by_free = np.concatenate([[by_cut.sum()], [by_cut[k:].sum() * np.exp(free[k]) for k in range(1, len(free))]])
        by_weight = ridge * w
        for own, at, size in blocks:
            by_weight += np.bincount(at, np.repeat(by_score[own], size), buckets)
        grads = [by_weight, by_free + ridge * free]
        for i, (value, g) in enumerate(zip((w, free), grads)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            value -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        if step > 1:  # what the data hardly move goes back to 0, so that long texts gather no noise
            pull = rate * lasso / (np.sqrt(second[0] / (1 - 0.999**step)) + 1e-8)
            w -= np.sign(w) * np.minimum(np.abs(w), pull)
    return Model(w.astype(np.float32), np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))]))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, grade: str, n_grades: int, buckets: int = 1 << 18, max_labelled: int = 12_000) -> Model | None:
    """Fit on at most max_labelled rated documents, the one of the least text hash where rows repeat an id; None without any."""
    ship(docs.sparkSession)
    rated = labels.select(F.col(key).alias("id"), F.col(grade).cast("int").alias("grade")).dropna().groupBy("id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("id"), "id").limit(max_labelled)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slots = [np.unique(np.array([slot(t, buckets) for t in tokens(x or "")], np.int32)).tobytes() for x in batch["text"]]
            yield pd.DataFrame({"grade": batch["grade"], "slots": slots})
        trim()

    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id").agg(F.min(F.struct(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("hash"), "text", "grade")).alias("one"))
    found = texts.select("one.grade", "one.text").mapInPandas(featurise, "grade int, slots binary").collect()
    if not found:
        return None
    found = sorted((r["grade"], bytes(r["slots"])) for r in found)
    grades = np.clip(np.array([g for g, _ in found]), 0, n_grades - 1)
    model = fit([np.frombuffer(s, np.int32) for _, s in found], grades, n_grades, buckets)
    del found
    trim()
    return model


def scored(docs: DataFrame, text: str, model: Model | None, n_grades: int, min_grade: int, min_tail: float, out: str) -> DataFrame:
    """docs with the struct `out`: score, expected_grade, tail (P(grade >= k) for k from 1) and kept (P(grade >= min_grade) >= min_tail)."""
    kind = "struct<score:double,expected_grade:double,tail:array<double>>"
    if model is None:
        return docs.withColumn(out, F.lit(None).cast(kind)).withColumn(out, F.struct(f"{out}.*", F.lit(True).alias("kept")))
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*sent.value)
        buckets, known = len(own.weights), {}

        def weight(token: str) -> float:
            value = known.get(token)
            if value is None:
                value = float(own.weights[slot(token, buckets)])
                if len(known) >= CACHE_ENTRIES:
                    known.clear()
                if len(token) <= 64:
                    known[token] = value
            return value

        for batch in batches:
            total = np.array([sum(map(weight, sorted(tokens(t)))) for t in batch], np.float64)
            tails = own.tails(total)
            yield pd.DataFrame({"score": total, "expected_grade": tails.sum(axis=1), "tail": list(tails)})
        known.clear()
        trim()

    found = docs.withColumn(out, run(F.coalesce(F.col(text), F.lit(""))))
    return found.withColumn(out, F.struct(f"{out}.*", (F.col(out)["tail"][min_grade - 1] >= min_tail).alias("kept")))


def score(docs: DataFrame, text: str, model: Model | None, n_grades: int, min_grade: int, min_tail: float) -> DataFrame:
    """docs with the columns of `scored`; those that docs has under these names are replaced."""
    names = ("score", "expected_grade", "tail", "kept")
    (all_,) = fresh(docs, "_scored")
    found = scored(docs, text, model, n_grades, min_grade, min_tail, all_)
    return found.select(*[c for c in docs.columns if c not in names], *[F.col(all_)[n].alias(n) for n in names])
