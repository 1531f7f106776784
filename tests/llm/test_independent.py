"""Scores, ratios and places against plain Python that shares no code with the operators."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starkit.llm import language, sharding, toxicity

SMALL = "/root/testdata/sf0.001"
WORD = 1 << 64
STEP = 0x9E3779B97F4A7C15


def plain_letters(text):
    """Lower-cased letters, runs of all else as one space, a space at both ends."""
    kept = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    words = kept.split(" ")
    words = [w for w in words if w]
    return " " + " ".join(words) + " " if words else ""


def plain_features(text, orders, bits):
    """How often each feature of a text occurs: n-grams hashed letter by letter."""
    found, codes = Counter(), [ord(c) for c in plain_letters(text)]
    for start in range(len(codes)):
        value = None
        for order in range(1, max(orders) + 1):
            if start + order > len(codes):
                break
            if value is None:
                value = (codes[start] + 1) * STEP % WORD
            else:
                value = ((value ^ (value >> 29)) * STEP + codes[start + order - 1]) % WORD
            if order in orders:
                found[((value ^ (value >> 32)) * STEP % WORD) >> (64 - bits)] += 1
    return found


def some_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]


def test_language_scores_row_by_row(spark):
    docs, rows = some_documents(spark)
    model = language.train_on_rest(docs)
    learned = [(i, t) for i, t, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    frequency, total = Counter(), 0
    for _, text in learned:
        own = plain_features(text, (1, 2, 3), 15)
        frequency.update(own.keys())
        total += bool(own)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs.select("doc_id", "text"), model).collect()}
    for doc_id, text, _ in rows[:120]:
        own = plain_features(text, (1, 2, 3), 15)
        if not own:
            assert found[doc_id] == ("und", 0.0)
            continue
        vector = {k: (1 + math.log(n)) * (math.log((1 + total) / (1 + frequency[k])) + 1) for k, n in own.items()}
        length = math.sqrt(sum(v * v for v in vector.values()))
        logits = [sum(float(w[k]) * v / length for k, v in vector.items()) / model.temperature for w in model.weights]
        raised = [math.exp(x - max(logits)) for x in logits]
        best = raised.index(max(raised))
        assert found[doc_id][0] == model.languages[best]
        assert found[doc_id][1] == pytest.approx(raised[best] / sum(raised), abs=1e-6)


def test_toxicity_scores_row_by_row(spark):
    docs, rows = some_documents(spark)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    model = toxicity.train(toxicity.labelled_rows(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    spec, counts, classes = toxicity.SPEC, (Counter(), Counter()), [0, 0]
    for doc_id, text, _ in rows:
        if labels.get(doc_id) in (0, 1) and zlib.crc32(str(doc_id).encode()) % 5:
            classes[labels[doc_id]] += 1
            counts[labels[doc_id]].update(plain_features(text, spec.orders, spec.bits).keys())

    def ratio(feature):
        clean, toxic = counts[0][feature] + 1, counts[1][feature] + 1
        value = math.log(toxic / (classes[1] + 2)) - math.log(clean / (classes[0] + 2))
        return value if abs(value) > 3 * math.sqrt(1 / clean + 1 / toxic) else 0.0

    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for doc_id, text, _ in rows[:120]:
        own = plain_features(text, spec.orders, spec.bits).keys()
        vector = {k: ratio(k) for k in own}
        assert all(model.ratios[k] == pytest.approx(v, abs=1e-9) for k, v in vector.items())
        length = math.sqrt(sum(v * v for v in vector.values())) or 1.0
        logit = sum(float(model.weights[k]) * v / length for k, v in vector.items()) + model.bias
        assert found[doc_id] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)


def plain_mixed(value):
    for _ in range(2):
        value = (value ^ (value >> 32)) * 0xD6E8FEB86659FD93 % WORD
    return value ^ (value >> 32)


def plain_walk(number, count):
    """A Feistel network over the smallest even number of bits that holds ``count``, again and
    again until the result is a row."""
    half = max(1, math.ceil((count - 1).bit_length() / 2)) if count > 1 else 1
    keys = [plain_mixed((k * STEP + sharding.SEED) % WORD) for k in range(1, 7)]
    while True:
        left, right = divmod(number, 1 << half)
        for key in keys:
            left, right = right, left ^ (plain_mixed(right ^ key) % (1 << half))
        number = (left << half) + right
        if number < count:
            return number


def test_shards_row_by_row(spark):
    docs, rows = some_documents(spark)
    found = sharding.shard_documents(docs).collect()
    assert sorted(r["row_number"] for r in found) == list(range(len(rows)))
    texts = {i: (t or "").encode() for i, t, _ in rows}
    for r in found:
        place = plain_walk(r["row_number"], len(rows))
        assert (r["shard"], r["slot"]) == (place % 40, place // 40)
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]]))


def test_samples_are_bounded_in_rows_and_bytes(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"), (F.col("id") % 2).cast("int").alias("toxic")
    )
    sample = language.sampled(rows, "toxic", 200, "doc_id").withColumn("blob", F.lit(bytes(100)))
    few = language.collected(sample, 200)
    assert 100 < len(few) <= 400 and [r["order"] for r in few] == sorted(r["order"] for r in few)
    assert [r["doc_id"] for r in language.collected(sample.repartition(3), 200)] == [r["doc_id"] for r in few]
    assert [r["doc_id"] for r in language.collected(sample, 20)] == [r["doc_id"] for r in few][:40]
    assert [r["doc_id"] for r in language.collected(sample, 200, most_bytes=1050)] == [r["doc_id"] for r in few][:10]
    assert len(language.collected(sample, 200, most_bytes=1)) == 1
    assert language.collected(sample.limit(0), 200) == []
    copies = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit("copy").alias("text"), F.lit(1).alias("toxic"))
    assert len(language.collected(language.sampled(copies, "toxic", 1000, "doc_id"), 20)) == 40
