"""Toxicity: a linear classifier on character n-grams scaled by log-count ratios.

For each n-gram, r is the logarithm of how much more often toxic training texts hold it
than others (naive Bayes), or zero where the counts do not tell the classes apart: the
rare n-grams of single texts would teach the regression those texts. These counts cover
every labelled training row. A text is the
vector of r over the n-grams it holds, scaled to unit length, and a logistic regression
on a bounded sample of labelled rows weighs them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import documents, fold, slices
from starkit.llm.language import sampled
from starkit.llm.ngrams import NgramSpec, letters, presence

SPEC = NgramSpec(orders=(3, 4, 5), bits=18)
# Rows that the regression is fitted on, half of each class, at most.
SAMPLE_ROWS = 4000
# Labels that are broadcast at most (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
SMOOTHING = 1.0
# A ratio counts if it is so many standard errors from zero.
CERTAINTY = 3.0
PENALTY = 1e-4
STEPS = 300


class ToxicityModel(NamedTuple):
    weights: np.ndarray  # of each n-gram, its log-count ratio
    ratios: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a text without a letter has the score of no evidence."""
        present = presence(letters(text), SPEC)
        values = scaled(present, self.ratios)
        return float(sigmoid(self.weights[present] @ values + self.bias))


def sigmoid(value):
    return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def scaled(present: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[present].astype(np.float64)
    length = np.sqrt(values @ values)
    return values / length if length else values


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many rows of each class an n-gram occurs, and the rows of each class: two
    numbers for each feature, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, seen = np.zeros((2, SPEC.size), np.int64), [0, 0]
        for batch in slices(batches):
            for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
                totals[toxic, presence(letters(text), SPEC)] += 1
                seen[toxic] += 1
        present = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(present, -1)),
                pa.array(np.append(totals[0, present], seen[0])),
                pa.array(np.append(totals[1, present], seen[1])),
            ],
            names=["feature", "clean", "toxic"],
        )

    partial = rows.select("toxic", "text").mapInArrow(
        run, "feature bigint, clean bigint, toxic bigint"
    )
    merged = partial.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = np.zeros((2, SPEC.size + 1), np.int64)
    frame = merged.toPandas()
    found[0, frame["feature"]], found[1, frame["feature"]] = frame["clean"], frame["toxic"]
    return found[:, :-1], found[:, -1]


def log_count_ratios(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """From the rows of each class (clean, toxic) with each feature, and the rows of each."""
    clean, toxic = counts + SMOOTHING
    most = rows + 2 * SMOOTHING
    ratios = np.log(toxic / most[1]) - np.log(clean / most[0])
    return np.where(np.abs(ratios) > CERTAINTY * np.sqrt(1 / clean + 1 / toxic), ratios, 0.0)


def fit(examples: list[tuple[np.ndarray, int]], ratios: np.ndarray, share: float) -> ToxicityModel:
    """Logistic regression by Adam on all examples; ``share`` is the part of toxic rows in
    the whole of the labels, which a balanced sample does not show."""
    if len({label for _, label in examples}) < 2:
        chance = min(max(share, 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(SPEC.size), ratios, float(np.log(chance / (1 - chance))))
    vectors = [scaled(present, ratios) for present, _ in examples]
    features = np.concatenate([present for present, _ in examples])
    values = np.concatenate(vectors)
    row = np.repeat(np.arange(len(examples), dtype=np.int32), [len(vector) for vector in vectors])
    labels = np.array([label for _, label in examples], float)
    used, column = np.unique(features, return_inverse=True)
    weights, bias = np.zeros(len(used)), 0.0
    mean, spread = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        logits = np.bincount(row, values * weights[column], len(examples)) + bias
        error = (sigmoid(logits) - labels) / len(examples)
        slope = np.bincount(column, values * error[row], len(used)) + PENALTY * weights
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope * slope
        change = 0.1 * mean / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - change[:-1], bias - change[-1]
    full = np.zeros(SPEC.size)
    full[used] = weights
    return ToxicityModel(full, ratios, float(bias))


def train(rows: DataFrame, bound: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from ``rows(doc_id, text, toxic)`` with labels 0 and 1, all of which may be
    learned from.

    Other labels teach nothing. A null, empty or letterless text is a row without n-grams; whole
    texts are learned from, however long; repeated rows count each. Without rows every score is
    a half.
    """
    rows = rows.filter(F.col("toxic").isin(0, 1))
    counts, classes = class_counts(rows)
    ratios = log_count_ratios(counts, classes)
    shared = rows.sparkSession.sparkContext.broadcast(ratios != 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text in batch["text"].to_pylist():
                present = presence(letters(text), SPEC)
                # A feature without a ratio cannot change the regression.
                found.append(present[shared.value[present]].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], batch["order"], pa.array(found, pa.binary())],
                names=["toxic", "order", "features"],
            )

    sample = sampled(rows, "toxic", bound, "doc_id").limit(2 * bound)
    found = sample.select("toxic", "order", "text").mapInArrow(
        run, "toxic int, order bigint, features binary"
    )
    examples = [
        (np.frombuffer(features, np.int32), toxic)
        for toxic, _, features in sorted(found.collect(), key=lambda r: (r["order"], r["toxic"]))
    ]
    share = classes[1] / classes.sum() if classes.sum() else 0.5
    return fit(examples, ratios, float(share))


def held_out(modulus: int = 5):
    """Whether a row is kept for testing; a row without id is never learned from."""
    return F.coalesce(fold(F.col("doc_id"), modulus) == 0, F.lit(True))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, toxic)`` of the rows that may be learned from. An id with labels of
    both kinds teaches neither."""
    own = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter(F.col("toxic") == F.col("most"))
        .drop("most")
    )
    if own.count() <= BROADCAST_LABELS:
        own = F.broadcast(own)
    return documents(docs).join(own, "doc_id")


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score)`` of every whole text.

    Null, empty and letterless texts have the score of no evidence. Rows without id and repeated
    rows are scored each; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            found = [model.score(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    return documents(docs).mapInArrow(run, "doc_id bigint, score double")
