"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every training row. The weights are fitted on a
bounded sample of them by follow-the-regularised-leader (FTRL-proximal), whose
elastic-net penalty leaves most weights at exactly zero. A part of the sample that the
weights have not seen sets the temperature by which probabilities are calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import fold, slices, stored
from starkit.llm.ngrams import NgramSpec, counts, letters

SPEC = NgramSpec(orders=(1, 2, 3), bits=15)
# Rows that the weights are fitted on at most, spread evenly over the languages.
SAMPLE_ROWS = 3000
# What the features of a sample may have on the driver.
SAMPLE_BYTES = 64 << 20
# Of the sample, one row in so many sets the temperature.
CALIBRATION_PART = 5
EPOCHS = 2
UNKNOWN = "und"

ALPHA, BETA, LAMBDA1, LAMBDA2 = 0.5, 1.0, 0.02, 0.001


class LanguageModel(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x features
    temperature: float

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        return tfidf(text, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability; ``und`` and 0 without a letter."""
        found = self.vector(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0
        present, values = found
        logits = (self.weights[:, present] @ values) / self.temperature
        chances = softmax(logits)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def tfidf(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and their weights with unit length; None without a letter."""
    codes = letters(text)
    if not len(codes):
        return None
    present, found = counts(codes, SPEC)
    values = (1 + np.log(found)) * idf[present]
    length = np.sqrt(values @ values)
    return present, values / length if length else values


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows each feature occurs, and the rows with a letter. The result has one
    number per feature, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows_seen = np.zeros(SPEC.size, np.int64), 0
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                codes = letters(text)
                if len(codes):
                    totals[counts(codes, SPEC)[0]] += 1
                    rows_seen += 1
        present = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(present, -1)),
                pa.array(np.append(totals[present], rows_seen)),
            ],
            names=["feature", "rows"],
        )

    partial = rows.select("text").mapInArrow(run, "feature bigint, rows bigint")
    found = np.zeros(SPEC.size + 1, np.int64)
    for feature, total in partial.groupBy("feature").agg(F.sum("rows")).collect():
        found[feature] = total
    return found[:-1], int(found[-1])


def sampled(rows: DataFrame, label: str, bound: int, key: str) -> DataFrame:
    """About ``bound`` rows, evenly over the values of ``label``, by a hash of ``key`` and
    text, which stands in ``order``."""
    sizes = {value: n for value, n in rows.groupBy(label).count().collect()}
    rows = rows.withColumn("order", F.xxhash64(key, "text", F.lit(1)))
    if not sizes:
        return rows.limit(0)
    share = bound / len(sizes)
    parts = 1 << 30
    chance = F.pmod(F.xxhash64(key, "text"), F.lit(parts))
    kept = F.lit(False)
    for value, n in sizes.items():
        kept = kept | ((F.col(label) == value) & (chance < int(parts * min(1.0, share / n))))
    return rows.filter(kept)


def collected(examples: DataFrame, bound: int, most_bytes: int = SAMPLE_BYTES) -> list:
    """The first ``2 * bound`` rows of sampled ``examples(order, ...)`` in their order, as far as
    their binary columns have ``most_bytes`` in all; so the driver's share is bounded in rows and
    in bytes, and the same rows are left out each time."""
    examples = stored(examples.withColumn("row", F.monotonically_increasing_id()), "examples")
    blobs = [name for name, kind in examples.dtypes if kind == "binary"]
    size = sum((F.octet_length(name) for name in blobs), F.lit(0)).alias("size")
    first = examples.select("order", "row", size).orderBy("order", "row").limit(2 * bound).collect()
    total, last = 0, None
    for row in first:
        total += row["size"]
        if total > most_bytes and last is not None:
            break
        last = row
    if last is None:
        return []
    within = (F.col("order") < last["order"]) | (
        (F.col("order") == last["order"]) & (F.col("row") <= last["row"])
    )
    return sorted(examples.filter(within).collect(), key=lambda r: (r["order"], r["row"]))


class Ftrl:
    """FTRL-proximal for a softmax over rows of sparse features."""

    def __init__(self, classes: int, size: int) -> None:
        self._z = np.zeros((classes, size))
        self._n = np.zeros((classes, size))

    def weights(self, features) -> np.ndarray:
        z, n = self._z[:, features], self._n[:, features]
        strength = (BETA + np.sqrt(n)) / ALPHA + LAMBDA2
        return np.where(np.abs(z) <= LAMBDA1, 0.0, (np.sign(z) * LAMBDA1 - z) / strength)

    def learn(self, features: np.ndarray, values: np.ndarray, target: int) -> None:
        weights = self.weights(features)
        error = softmax(weights @ values)
        error[target] -= 1
        gradient = error[:, None] * values
        n = self._n[:, features]
        grown = n + gradient * gradient
        rate = (np.sqrt(grown) - np.sqrt(n)) / ALPHA
        self._z[:, features] += gradient - rate * weights
        self._n[:, features] = grown


def _temperature(logits: list[np.ndarray], targets: list[int]) -> float:
    """The one that makes the held-back rows likeliest, by golden-section search."""
    if not logits:
        return 1.0
    scores, rows = np.array(logits), np.arange(len(targets))

    def loss(exponent: float) -> float:
        chances = softmax(scores / np.exp(exponent))[rows, targets]
        return -np.log(np.maximum(chances, 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) < loss(right) else (left, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, bound: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from ``rows(doc_id, text, lang)``, all of which may be learned from.

    Rows without language, and texts that are null or have no letter, teach nothing. Whole
    texts are learned from, however long; repeated rows count each. No rows give a model that
    knows no language.
    """
    labelled = rows.filter(F.col("lang").isNotNull())
    frequencies, total = document_frequencies(labelled)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    shared = labelled.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for lang, order, text in zip(
                batch["lang"].to_pylist(), batch["order"].to_pylist(), batch["text"].to_pylist()
            ):
                found = tfidf(text, shared.value)
                if found is not None:
                    features, values = found[0].astype(np.int32), found[1].astype(np.float32)
                    kept.append((lang, order, features.tobytes(), values.tobytes()))
            types = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*kept) if kept else [[]] * 4, types)],
                names=["lang", "order", "features", "values"],
            )

    sample = sampled(labelled, "lang", bound, "doc_id")
    found = sample.select("lang", "order", "text").mapInArrow(
        run, "lang string, order bigint, features binary, values binary"
    )
    examples = collected(found, bound)
    languages = sorted({row["lang"] for row in examples})
    number = {lang: place for place, lang in enumerate(languages)}
    learner = Ftrl(len(languages), SPEC.size)
    ready = [
        (np.frombuffer(r["features"], np.int32), np.frombuffer(r["values"], np.float32), number[r["lang"]])
        for r in examples
    ]
    learned = [row for place, row in enumerate(ready) if place % CALIBRATION_PART]
    for _ in range(EPOCHS):
        for features, values, target in learned:
            learner.learn(features, values, target)
    weights = learner.weights(slice(None))
    kept_back = ready[::CALIBRATION_PART]
    temperature = _temperature(
        [weights[:, features] @ values for features, values, _ in kept_back],
        [target for _, _, target in kept_back],
    )
    return LanguageModel(languages, idf, weights.astype(np.float32), temperature)


def identify(docs: DataFrame, model: LanguageModel, columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language of every whole text and its probability.

    The columns of ``docs`` are kept as they are and must not include the two new names.
    A text that is null or has no letter is ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        found = [shared.value.predict(text) for text in texts]
        return pd.DataFrame(found, columns=["lang", "score"])

    place = columns[0]
    marked = docs.withColumn(place, predict(F.col("text").cast("string")))
    return marked.withColumns({columns[1]: F.col(f"{place}.score"), place: F.col(f"{place}.lang")})


def held_out(modulus: int = 4, remainder: int = 2):
    """Whether a row is kept for testing; a row without id is never learned from."""
    return F.coalesce(fold(F.col("doc_id"), modulus) == remainder, F.lit(True))


def train_on_rest(docs: DataFrame, bound: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from the rows of ``docs`` that are not held out."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    return train(rows.filter(~held_out()), bound)
