"""Texts of megabytes, and tables whose extra columns have the operators' own names."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starkit.llm import bpe, exact, hosts, language, nearest, packing, phrases, simhash, substrings, toxicity, trie
from starkit.llm.pieces import cut_documents

WORD = public_tokenizers.path("word_bpe_49k.json")
OWN_NAMES = ["score", "rank", "query_id", "dim", "block", "copy", "q", "share", "tile", "depth", "part", "place", "ref"]


def long_text(seed, count):
    rnd = random.Random(seed)
    return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(5000)}{rnd.choice(['', '', '.', ',', chr(10)])}" for _ in range(count))


@pytest.fixture(scope="module")
def long_documents(spark):
    text = long_text(1, 200_000)
    assert len(text) > 1_000_000
    rows = [(1, text), (2, f"ahead {text}"), (3, text), (4, "x" * 1_000_000), (5, None), (6, "a short one")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s")), text


def test_long_texts_are_read_whole(spark, long_documents):
    docs, text = long_documents
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    found = {r["doc_id"]: r for r in exact.duplicates(docs).collect()}
    assert (found[3]["keep_id"], found[3]["group_size"], found[3]["kept"]) == (1, 2, False)
    content = re.sub(r"[\x20\x09-\x0D]", "", text).encode()
    assert bytes(found[1]["text_digest"]) == hashlib.sha256(content).digest()
    removed = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(docs).collect()}
    assert removed == {1: (words, 0), 2: (words + 1, words), 3: (words, words), 4: (1, 0), 5: (0, 0), 6: (3, 0)}
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert groups[1] == groups[2] == groups[3] == 1
    measured = {r["doc_id"]: r["n_words"] for r in hosts.judged(docs).collect()}
    assert measured == {1: words, 2: words + 1, 3: words, 4: 1, 5: 0, 6: 3}
    total = phrases.frequent_phrases(docs.withColumn("lang", F.lit("en")), 3).filter("size = 0").first()
    pieces = len([w for w in re.findall(r"[^ \t.,;:!?\n-\r]+", text)])
    assert total["count"] == 3 * pieces + 1 + 1 + 3


def test_long_texts_are_encoded_and_packed_whole(spark, long_documents):
    docs, _ = long_documents
    docs = docs.filter("doc_id IN (1, 4, 5)")
    lengths = {r["doc_id"]: r["n"] for r in cut_documents(docs, WORD).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    encoded = {r["doc_id"]: r["n"] for r in bpe.encode(docs, WORD).select("doc_id", F.size("ids").alias("n")).collect()}
    assert lengths == {doc_id: n + 1 for doc_id, n in encoded.items()} and lengths[1] > 200_000
    packed = packing.pack_documents(docs, WORD)
    assert packed.agg(F.sum("length")).first()[0] == sum(lengths.values())


def test_models_take_long_texts(spark, long_documents):
    docs, _ = long_documents
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 4, "xx").otherwise("yy"))
    model = language.train(docs)
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} <= {"xx", "yy", "und"}
    rows = docs.select("doc_id", "text", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    scored = toxicity.score(docs, toxicity.train(rows)).collect()
    assert len(scored) == 6 and all(0 <= r["score"] <= 1 for r in scored)


def test_vectors_and_labels_with_the_operators_own_names(spark, awkward):
    rnd = np.random.default_rng(3)
    plain = spark.createDataFrame([(k, rnd.normal(size=6).tolist()) for k in range(40)], "vec_id long, vector array<double>")
    clashing = plain.withColumns({name: F.lit("clash") for name in OWN_NAMES})
    queries = "vec_id % 10 = 0"
    found = nearest.nearest(clashing, clashing.filter(queries), 3).collect()
    assert sorted(found) == sorted(nearest.nearest(plain, plain.filter(queries), 3).collect()) and found
    labels = spark.createDataFrame([(k, k % 2) for k in range(14)], "doc_id long, toxic long")
    named = labels.withColumns({"text": F.lit("clash"), "most": F.lit(1), "score": F.lit(2)})
    one, other = (toxicity.labelled_rows(awkward, table) for table in (labels, named))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_conversations_with_long_turns_and_clashing_names(spark):
    text = long_text(2, 50_000)
    turns = [(c, k, "user", text if k == 0 else f"{c} {k}") for c in (0, 1, 2) for k in range(3)]
    plain = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    clashing = plain.withColumns({name: F.lit("clash") for name in [*OWN_NAMES, "h", "m", "base", "words", "f1", "p1", "n_convs"]})
    one, other = (sorted(map(str, trie.prefix_trie(table).collect())) for table in (plain, clashing))
    assert one == other and len(one) > 3
