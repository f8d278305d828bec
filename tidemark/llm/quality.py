"""Quality of texts by ordinal regression on graded ratings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.words import Words, chunks, mixed, tables, words

#: Hashed features shared by all grades.
BUCKETS = 1 << 18
#: Bounds of the sample that the model is fitted on: rated documents, the first by hash of
#: the id, and characters of one. Scoring has no such bound.
SAMPLE, SAMPLE_CHARS = 8_000, 20_000
STEPS, RATE, DECAY = 150, 1.0, 1e-4
#: A bucket that fewer documents of the sample have gets no weight: it would only name them. A
#: count, not a share, so that rare marks count in a sample of any size.
LEAST = 3
#: Evidence (a likelihood ratio's logarithm, doubled) at which a bucket counts half.
DOUBT = 10.0


@dataclass
class Model:
    grades: list[int]  # ascending
    weights: np.ndarray  # one a bucket, shared by all grades
    telling: np.ndarray  # one a bucket, 0 where the sample had too few documents of it
    thresholds: np.ndarray  # ascending, one between each two grades

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= grades[j]) for j from 1 on; a row per score."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(values + np.uint64(kind << 48)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of hashed features: words, word pairs, written signs, and
    how words are capitalised, each with its log-scaled count."""
    found: Words = words(texts)
    letter, _ = tables()
    hashes, doc = found.hashes(), found.doc
    pair = doc[1:] == doc[:-1]
    upper = found.raw[found.start] != found.codes[found.start]
    second = np.minimum(found.start + 1, len(found.raw) - 1)
    shout = upper & (found.size > 1) & (found.raw[second] != found.codes[second])
    shape = upper.astype(np.uint64) + shout.astype(np.uint64)
    sign = np.flatnonzero(~letter[found.raw] & (found.raw > 32))
    sign_doc = np.searchsorted(found.offset, sign, side="right") - 1
    owner = np.concatenate((doc, doc[1:][pair], doc, sign_doc))
    bucket = np.concatenate(
        (
            _bucket(hashes, 1),
            _bucket(hashes[:-1][pair] * np.uint64(31) + hashes[1:][pair], 2),
            _bucket(shape, 3),
            _bucket(found.raw[sign].astype(np.uint64), 4),
        )
    )
    key, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, np.log1p(count)


def _weighed(
    owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, telling: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features that the model knows, by how telling they are, of length 1 for each document."""
    value = value * telling[bucket]
    known = value > 0
    owner, bucket, value = owner[known], bucket[known], value[known]
    norm = np.sqrt(np.bincount(owner, value**2, n))
    return owner, bucket, value / norm[owner]


def _telling(owner: np.ndarray, bucket: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """How far the grades of a bucket's documents are from all grades, as a root of the evidence
    a document; less where the bucket's evidence is little, as it is by chance in many rare ones.
    By rarity alone, the many rare buckets of any text would drown the few that tell."""
    having = np.bincount(bucket, minlength=BUCKETS)
    most = np.zeros(BUCKETS)
    for j in range(k):
        above = y > j
        share = np.clip(above.mean(), 1e-3, 1 - 1e-3)
        yes = np.bincount(bucket, above[owner], BUCKETS)
        evidence = np.zeros(BUCKETS)
        for part, p in ((yes, share), (having - yes, 1 - share)):
            evidence += 2 * part * np.log(np.maximum(part, 1e-9) / (np.maximum(having, 1) * p))
        most = np.maximum(most, evidence)
    root = np.sqrt(most / np.maximum(having, 1))
    return np.where(having >= LEAST, root * most / (most + DOUBT), 0.0)


def fit(texts: Sequence[str], grades: Sequence[int]) -> Model:
    """Cumulative-link model: P(grade > g_j) = sigmoid(score - threshold_j), score a weighted
    sum of features. Thresholds are kept in order by fitting the logarithm of their steps."""
    levels = sorted(set(grades))
    if len(levels) < 2:
        return Model(levels, np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(0))
    y = np.searchsorted(levels, grades)
    owner, bucket, value = (
        np.concatenate(x)
        for x in zip(*[(o + a, b, v) for a, e in chunks(texts) for o, b, v in [features(texts[a:e])]])
    )
    n, k = len(y), len(levels) - 1
    telling = _telling(owner, bucket, y, k)
    owner, bucket, value = _weighed(owner, bucket, value, telling, n)
    share = np.clip([(y > j).mean() for j in range(k)], 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    first, steps = start[0], np.log(np.maximum(np.diff(start), 0.1))
    weights, speed, speed_t = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8), np.full(k, 1e-8)
    rows = np.arange(n)
    for _ in range(STEPS):
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))
        score = np.bincount(owner, weights[bucket] * value, n)
        above = np.ones((n, k + 2))  # P(y >= j), j from 0 to k + 1
        above[:, 1:-1] = _sigmoid(score[:, None] - thresholds)
        above[:, -1] = 0
        slope = above * (1 - above)
        mass = np.maximum(above[rows, y] - above[rows, y + 1], 1e-9)
        pull = (slope[rows, y] - slope[rows, y + 1]) / mass  # d log P / d score
        gradient = np.bincount(bucket, pull[owner] * value, BUCKETS) / n - DECAY * weights
        speed += gradient**2
        weights += RATE * gradient / np.sqrt(speed)
        down = np.zeros(k)  # d log P / d threshold
        for j in range(k):
            down[j] = ((y == j) * slope[:, j + 1] / mass - (y == j + 1) * slope[:, j + 1] / mass).mean()
        chain = np.concatenate(([down.sum()], np.exp(steps) * np.cumsum(down[::-1])[::-1][1:]))
        speed_t += chain**2
        move = 0.1 * chain / np.sqrt(speed_t)
        first, steps = first + move[0], steps + move[1:]
    thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))
    return Model(levels, weights.astype(np.float32), telling.astype(np.float32), thresholds)


def _scores(model: Model, texts: list[str | None]) -> pd.DataFrame:
    score = np.zeros(len(texts))
    for a, b in chunks(texts):
        owner, bucket, value = _weighed(*features(texts[a:b]), model.telling, b - a)
        score[a:b] = np.bincount(owner, model.weights[bucket] * value, b - a)
    tail = model.at_least(score)
    grades = np.array(model.grades, float)
    expected = grades[0] + tail @ np.diff(grades)
    top = tail[:, -1] if tail.shape[1] else np.ones(len(texts))
    return pd.DataFrame({"expected_grade": expected, "p_top": top})


def train(
    docs: DataFrame, ratings: DataFrame, grade: Column, id_column: str = "doc_id", text_column: str = "text"
) -> Model:
    """Fit on at most SAMPLE rated documents of up to SAMPLE_CHARS characters, the first by
    hash of the id. Ratings with a null id or grade, and of no document, are left out; each of
    several ratings of a document counts. Without a rating every grade is 0."""
    rank = F.xxhash64(F.col(id_column).cast("string"))
    rated = ratings.select(id_column, grade.cast("int").alias("grade")).dropna()
    texts = docs.select(id_column, F.col(f"`{text_column}`").alias("text")).filter(
        F.length("text") <= SAMPLE_CHARS
    )
    ids = texts.select(id_column).join(rated, id_column).withColumn("rank", rank)
    chosen = ids.orderBy("rank", id_column, "grade").limit(SAMPLE).select(id_column, "grade")
    rows = texts.join(F.broadcast(chosen), id_column).orderBy(rank, id_column, "grade", F.xxhash64("text"))
    rows = rows.limit(SAMPLE).collect()
    if not rows:
        return Model([0], np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(0))
    return fit([r["text"] for r in rows], [r["grade"] for r in rows])


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """Column of struct(expected_grade, p_top) for whole texts: the mean of the grade's
    distribution and the probability of the best grade. A null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, p_top double")
    def graded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory.only()
        for batch in batches:
            yield _scores(shared.value, batch.tolist())
        memory.give_back()

    # Not to be taken apart by the optimiser: a filter on a field would run it once more.
    return graded.asNondeterministic()(F.col(f"`{text_column}`"))


def grade(
    docs: DataFrame,
    ratings: DataFrame,
    rating: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    tail: float = 0.6,
) -> DataFrame:
    """``docs`` with expected_grade, p_top and selected (p_top of at least ``tail``); columns
    of these names are replaced. One row per row of ``docs``; an empty table gives none."""
    model = train(docs, ratings, rating, id_column, text_column)
    guess = docs.withColumn("__guess", predict(docs, model, text_column))
    return guess.withColumns(
        {
            "expected_grade": F.col("__guess.expected_grade"),
            "p_top": F.col("__guess.p_top"),
            "selected": F.col("__guess.p_top") >= tail,
        }
    ).drop("__guess")
