"""Language, toxicity, sharding, neighbours and the pipeline: held-out accuracy, laws,
brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starkit.llm import hosts, language, nearest, sharding, simhash, toxicity
from starkit.llm.common import documents, fresh_name
from starkit.llm.ngrams import NgramSpec, counts, features, letters, presence
from starkit.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# N-grams -----------------------------------------------------------------------


def test_letters_and_ngrams():
    text = lambda codes: "".join(map(chr, codes))
    assert text(letters("  Ab1C--é🙂")) == " ab c é "
    assert not len(letters("12 ?!")) and not len(letters("")) and not len(letters(None))
    spec = NgramSpec((1, 2), 12)
    codes = letters("abab")
    assert [len(part) for part in features(codes, spec)] == [6, 5]
    present, found = counts(codes, spec)
    assert found.sum() == 11 and sorted(present) == present.tolist() == presence(codes, spec).tolist()
    assert features(letters("abab")[1:5], spec)[1][0] == features(codes, spec)[1][1]


# Language ----------------------------------------------------------------------


def test_language_of_held_out_rows(spark):
    found = QUERIES["op6_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    right = found.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    rows = right.agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert rows[0] > 100 and rows[1] > 0.95


def test_language_does_not_see_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang")))
    one, other = language.train_on_rest(docs, 300), language.train_on_rest(wrong, 300)
    assert one.languages == other.languages and (one.weights == other.weights).all()
    assert one.temperature == other.temperature


def test_ftrl_learns_and_stays_sparse():
    rnd, learner = np.random.default_rng(1), language.Ftrl(2, 50)
    for _ in range(400):
        target = int(rnd.integers(2))
        noise = rnd.choice(np.arange(2, 50), 5, replace=False)
        learner.learn(np.append(noise, target), np.full(6, 6**-0.5), target)
    weights = learner.weights(slice(None))
    assert weights[0, 0] > 0.5 and weights[1, 1] > 0.5
    assert (weights == 0).any()


def test_temperature_undoes_overconfidence():
    rnd = np.random.default_rng(2)
    logits = rnd.normal(size=(4000, 3))
    targets = [int(rnd.choice(3, p=language.softmax(row))) for row in logits]
    assert language._temperature(list(5 * logits), targets) == pytest.approx(5, rel=0.15)
    assert language._temperature([], []) == 1.0


def test_language_of_awkward_rows(awkward, empty):
    docs = awkward.drop("score")
    model = language.train_on_rest(docs)
    found = language.identify(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "score"]
    for r in found.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr") and 0 <= r["score"] <= 1
    nothing = language.train_on_rest(empty)
    assert nothing.languages == [] and nothing.predict("some text") == ("und", 0.0)
    assert language.identify(empty.drop("score"), nothing).count() == 0


# Toxicity ----------------------------------------------------------------------


def test_ratios_and_regression_find_the_insults():
    rnd = random.Random(3)
    plain = ["river", "stone", "window", "garden", "letter", "morning"]
    texts, labels = [], []
    for k in range(300):
        words = rnd.choices(plain, k=20)
        if k % 5 == 0:
            words[rnd.randrange(20)] = "scoundrel"
        texts.append(" ".join(words))
        labels.append(int(k % 5 == 0))
    found = np.zeros((2, toxicity.SPEC.size), np.int64)
    examples = [(presence(letters(text), toxicity.SPEC), label) for text, label in zip(texts, labels)]
    for present, label in examples:
        found[label, present] += 1
    ratios = toxicity.log_count_ratios(found, np.array([240, 60]))
    model = toxicity.fit(examples, ratios, 0.2)
    assert model.score("the scoundrel sat in the garden by the river") > 0.5 > model.score(" ".join(plain))
    assert 0 <= model.score("") == model.score(None) <= 1


def test_toxicity_of_held_out_rows(spark):
    found = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    assert len(rows) > 500
    right = sum(r["toxic"] == r["predicted"] for r in rows) / len(rows)
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert right > 0.95 and sum(caught) / len(caught) > 0.7


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (2, 1), (None, 1), (3, 0), (8, 0), (10, None), (11, 7)], "doc_id long, toxic long"
    )
    rows = toxicity.labelled_rows(awkward, labels)
    wanted = {i: t for i, t in [(2, 1), (3, 0), (8, 0)] if zlib.crc32(str(i).encode()) % 5}
    assert {r["doc_id"]: r["toxic"] for r in rows.collect()} == wanted
    scored = toxicity.score(awkward, toxicity.train(rows)).collect()
    assert len(scored) == awkward.count() and all(0 <= r["score"] <= 1 for r in scored)
    untaught = toxicity.train(toxicity.labelled_rows(empty, labels))
    assert untaught.score("anything") == pytest.approx(0.5)
    assert toxicity.score(empty, untaught).count() == 0


# Sharding ----------------------------------------------------------------------


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 17, 1000, 4096, 70_001])
def test_permutation_and_its_inverse(count):
    rows = np.arange(count)
    found = sharding.permuted(rows, count)
    assert sorted(found) == rows.tolist()
    assert (sharding.permuted(found, count, back=True) == rows).all()
    if count > 100:
        assert (found != rows).mean() > 0.9
        assert (found != sharding.permuted(rows, count, seed=7)).mean() > 0.9
    shard, slot = sharding.place_of(rows, count, 7)
    assert (sharding.row_at(shard, slot, count, 7) == rows).all()


def test_shards_of_awkward_rows(awkward, empty):
    found = sharding.shard_documents(awkward, 4).collect()
    wanted = [
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
        for r in awkward.collect()
    ]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=str) == sorted(wanted, key=str)
    shards = {}
    for r in found:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    sizes = [len(shards.get(k, [])) for k in range(4)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard_documents(awkward.repartition(5), 4)
    assert sorted(map(str, found)) == sorted(map(str, again.collect()))
    assert sharding.shard_documents(empty).count() == 0


# Nearest neighbours --------------------------------------------------------------


def brute_force_nearest(rows, queries, k):
    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    candidates = sorted({(i, tuple(v)) for i, v in rows if i is not None and good(v)})
    asking = {}
    for i, v in queries:
        if i is not None and good(v):
            asking[i] = min(asking.get(i, tuple(v)), tuple(v))
    found = []
    for q, v in asking.items():
        scores = []
        for i, w in candidates:
            if i != q and len(w) == len(v):
                total = 0.0  # in order; sum() would compensate for rounding
                for a, b in zip(v, w):
                    total += a * b
                scores.append((-total, i))
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("query_block, candidate_block", [(1024, 2048), (3, 7)])
def test_neighbours_against_brute_force(spark, query_block, candidate_block):
    rnd = np.random.default_rng(6)
    rows = [(k, rnd.normal(size=8).tolist()) for k in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(30)]  # a hot vector
    rows += [(200 + k, (1000 * rnd.normal(size=8)).round().tolist()) for k in range(20)]
    rows += [(0, rows[0][1]), (5, rows[6][1]), (None, rows[1][1]), (300, None), (301, []), (302, [0.0] * 8)]
    rows += [(303, [float("nan")] + [1.0] * 7), (304, [float("inf")] * 8), (305, [None] + [1.0] * 7)]
    rows += [(306, [1.0, 2.0]), (307, [2.0, 1.0]), (308, [1e-310] * 8), (309, [7.0])]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    queries = table.filter("vec_id % 3 = 0 OR vec_id IS NULL")
    found = nearest.nearest(table, queries, 5, query_block, candidate_block)
    wanted = brute_force_nearest(rows, [r for r in rows if r[0] is None or r[0] % 3 == 0], 5)
    assert sorted(map(tuple, found.collect())) == wanted


def test_bounds_hold_and_most_pairs_are_excluded():
    rnd = np.random.default_rng(8)
    vectors = rnd.normal(size=(500, 32))

    def block(part, first):
        tile, scales, errors = nearest._quantised(part)
        ids = np.arange(first, first + len(part))
        return nearest.Block(ids, part, tile, scales, errors, np.linalg.norm(part, axis=1))

    queries, candidates = block(vectors[:20], 0), block(vectors, 0)
    first, second = nearest.survivors(queries, candidates, 5, np.full(20, -np.inf))
    exact = vectors[:20] @ vectors.T
    for q in range(20):
        best = [c for c in np.argsort(-exact[q]) if c != q][:5]
        assert set(best) <= set(second[first == q])
    assert len(first) < 20 * 40


def test_neighbours_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, vector array<float>")
    assert nearest.nearest(empty, empty).count() == 0


# Pipeline ------------------------------------------------------------------------


def test_stages_on_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF_DIR)
            assert after.columns == docs.columns, name
            assert after.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count()


def test_pipeline_against_its_operators(spark):
    """Each stage's decisions, taken from the operator's own rows, take effect."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    said = language.identify(docs, language.train_on_rest(docs))
    spoken = corpus_pipeline.known_language(spark, docs, SF_DIR)
    sure = said.filter("lang_pred <> 'und' AND score >= 0.5")
    assert sorted_rows(spoken, *docs.columns) == sorted_rows(sure, *docs.columns)
    good = corpus_pipeline.good_quality(spark, spoken, SF_DIR)
    kept = hosts.judged(spoken).filter("kept")
    assert sorted_rows(good, "doc_id") == sorted_rows(kept, "doc_id")
    first = corpus_pipeline.first_of_near_duplicates(spark, good, SF_DIR)
    found = simhash.near_duplicates(good, corpus_pipeline.NEAR_DISTANCE, corpus_pipeline.NEAR_WORDS)
    assert sorted_rows(first, "doc_id") == sorted_rows(found.filter("doc_id = component_id"), "doc_id")
    cut = corpus_pipeline.without_repeated_passages(spark, first, SF_DIR)
    lengths = cut.filter(F.col("n_chars") != F.length("text")).count()
    assert lengths == 0 and cut.count() == first.count()
    packed = corpus_pipeline.packed_sequences(spark, cut, SF_DIR)
    assert packed.select("doc_id").distinct().count() == cut.count()


def test_helpers(spark):
    df = spark.createDataFrame([(1, "x", 2)], "doc_id int, TEXT string, _Key int")
    assert fresh_name(df, "_key") == "__key" and fresh_name(df, "other") == "other"
    assert documents(df).dtypes == [("doc_id", "bigint"), ("text", "string")]
