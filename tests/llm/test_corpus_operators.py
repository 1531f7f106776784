"""Exact duplicates, phrases and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkit.llm import exact, phrases, trie


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# Exact duplicates ------------------------------------------------------------------


def brute_force_duplicates(pairs):
    """Per row without order: id, id that stays, rows of the group; how many rows stay is one
    a group."""
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text))
    for content, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(content.encode()).digest()
        for doc_id, _ in members:
            yield doc_id, best, len(members), digest


def one_byte(content):
    return F.unhex(F.substring(F.sha2(content, 256), 1, 1))


def copies(awkward):
    pairs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    pairs += [(50 - k, f"one{' ' * (k % 4)}two\nthree") for k in range(30)]
    pairs += [(None, "one two  three "), (None, "one two  three "), (-(2**63), "onetwothree"), (2**63 - 1, "x")]
    return pairs + [(60, "longer  text"), (61, "longer text"), (62, "longer\t\ttext")]


@pytest.mark.parametrize("salts", [1, 16])
def test_duplicates_of_awkward_rows(spark, awkward, empty, salts):
    pairs = copies(awkward)
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    found = exact.duplicates(docs, salts=salts)
    wanted = sorted(brute_force_duplicates(pairs), key=str)
    rows = found.collect()
    assert sorted(((r[0], r[1], r[2], bytes(r[4])) for r in rows), key=str) == wanted
    # One row of each group stays, repeated rows and rows without id included.
    kept = Counter(bytes(r["text_digest"]) for r in rows if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == {w[3] for w in wanted}
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert exact.duplicates(awkward).count() == awkward.count()
    assert exact.duplicates(empty).count() == 0


def test_contents_that_share_a_digest_stay_apart(spark, awkward):
    pairs = copies(awkward)
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    found = exact.duplicates(docs, digest=one_byte).collect()
    assert len({bytes(r["text_digest"]) for r in found}) < len({w[3] for w in brute_force_duplicates(pairs)})
    wanted = sorted((w[:3] for w in brute_force_duplicates(pairs)), key=str)
    assert sorted((tuple(r)[:3] for r in found), key=str) == wanted
    assert sum(r["kept"] for r in found) == len({w[3] for w in brute_force_duplicates(pairs)})


def test_copies_are_combined_before_they_are_shuffled(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    plan = exact.content_groups(
        docs.select("doc_id", F.lit(1).alias("points"), F.lit(b"d").alias("digest"), F.col("text").alias("content"))
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 2 and plan.count("partial_count") == 1


# Phrases -------------------------------------------------------------------------


def random_documents(seed, count):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(count):
        words = [rnd.choice(["a", "B", "c", "the", "Éé", "x　y", "dd"]) for _ in range(rnd.randint(0, 40))]
        text = "".join(w + rnd.choice([" ", "  ", "\t", ", ", ".", "\n", " ; ", "\x0b"]) for w in words)
        pairs.append((text, rnd.choice(["en", "fr", None, "und"])))
    return pairs + [(None, "en"), ("", None), (" \n", "fr"), ("long " * 3000, "de")]


def brute_force_counts(pairs, longest):
    counts, totals = Counter(), Counter()
    for text, lang in pairs:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, tuple(words[k : k + size])] += 1
    return counts, totals


def brute_force_collocations(pairs, threshold, longest, top):
    counts, totals = brute_force_counts(pairs, longest)
    frequent = {key: a for key, a in counts.items() if a >= threshold and len(key[1]) > 1}
    inside = set()
    for (lang, words), count in frequent.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                part = lang, words[k : k + size]
                if count >= counts[part]:
                    inside.add(part)
    found = defaultdict(list)
    for (lang, words), a in frequent.items():
        if (lang, words) not in inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    for lang, rows in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


@pytest.mark.parametrize("threshold, capacity, top", [(2, 1 << 20, 2000), (5, 8, 4), (100, 1, 2000)])
def test_collocations_against_brute_force(spark, monkeypatch, threshold, capacity, top):
    monkeypatch.setattr(phrases, "CAPACITY_FACTOR", 1)
    monkeypatch.setattr(phrases, "_MERGED_ROWS", 1)
    pairs = random_documents(threshold, 120)
    docs = spark.createDataFrame(pairs, "text string, lang string").withColumn("phrase", F.lit("clash"))
    found = phrases.collocations(docs.repartition(4), threshold, 5, top, capacity=capacity)
    wanted = sorted(brute_force_collocations(pairs, threshold, 5, top))
    assert sorted(tuple(r) for r in found.collect()) == wanted and wanted


def test_frequent_phrases_and_totals(spark):
    pairs = random_documents(8, 80)
    docs = spark.createDataFrame(pairs, "text string, lang string")
    counts, totals = brute_force_counts(pairs, 3)
    wanted = {(lang, len(w), " ".join(w), a) for (lang, w), a in counts.items() if a >= 4}
    wanted |= {(lang, 0, "", n) for lang, n in totals.items()}
    assert {tuple(r) for r in phrases.frequent_phrases(docs, 4, 3).collect()} == wanted


def test_phrases_of_an_empty_table(spark, awkward, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(awkward, 3).count() > 0


@pytest.mark.parametrize("seed", range(5))
def test_what_is_frequent_survives_any_capacity(seed, monkeypatch):
    monkeypatch.setattr(phrases, "CAPACITY_FACTOR", 1)
    rnd = np.random.default_rng(seed)
    summary, true = phrases.Summary(50, capacity=16), Counter()
    for _ in range(60):
        keys = np.concatenate([rnd.zipf(1.3, 200) % 1000, rnd.integers(10**6, 2**40, 400)])
        unique, counts = np.unique(keys, return_counts=True)
        summary.merge(unique, counts)
        true.update(dict(zip(unique.tolist(), counts.tolist())))
    frequent = {key for key, count in true.items() if count >= 50}
    assert frequent <= set(summary.survivors().tolist())
    assert summary.fallen < 50 and len(summary.keys) < len(true) / 2
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert all(true[k] - summary.fallen <= held.get(k, 0) <= true[k] for k in true)


# Prefix trie ---------------------------------------------------------------------


def brute_force_trie(turns):
    stored = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            stored[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv in stored:
        stored[conv] = [t[2:] for t in sorted(stored[conv])]
    rebuilt = {}
    for conv, own in stored.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        rebuilt[conv] = tuple(stored.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for conv, turns_ in rebuilt.items():
        for depth in range(len(turns_) + 1):
            members[turns_[:depth]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [sums[child] for child in children[node]]
        sums[node] = (sum(s[0] for s in below) or 1, own + sum(s[1] for s in below))
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        yield (min(convs), len(node), parent, len(convs), len(children[node]), *sums[node],
               hashlib.sha256(ends.encode()).hexdigest())


TURNS = "conv_id long, turn long, role string, text string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def random_turns(seed):
    rnd = random.Random(seed)
    turns = []
    for conv in [*range(70), 2003, -5, -40, 10**15]:
        for k in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            place = rnd.choice([k, k, k, None, 0])
            turns.append((conv, place, rnd.choice(["user", "assistant", None]), rnd.choice(["yes", "no thanks", "", None])))
    turns += [(None, 1, "user", "lost"), (3, 0, "user", "yes"), (3, 0, "user", "yes")]
    return [t for t in turns if t[0] != 20]  # a base without turns


@pytest.mark.parametrize("seed, bits", [(1, 61), (2, 1), (3, 61)])
def test_trie_against_brute_force(spark, seed, bits):
    turns = random_turns(seed)
    frame = spark.createDataFrame(turns, TURNS).withColumn("depth", F.lit("clash")).repartition(3)
    assert sorted_rows(trie.prefix_trie(frame, bits), *NODE) == sorted(brute_force_trie(turns), key=str)


def test_conversations_over_many_partitions(spark, monkeypatch):
    # Two conversations hold nearly all turns; their products are carried from task to task.
    monkeypatch.setattr(trie, "CHUNK_IDS", 2)
    turns = [(c, k, "user", f"turn {k % 3}") for c in (0, 5) for k in range(150)]
    turns += [(c, k, "user", f"turn {k % 3}") for c in range(6, 30) for k in range(2)]
    frame = spark.createDataFrame(turns, TURNS)
    hashes = trie.Hashes.of_attempt(0, trie.HASH_BITS)
    rows = trie._multiplied(trie.turns_of(frame), hashes)
    assert rows.filter("conv_id = 5").select("part").distinct().count() > 1
    assert sorted_rows(trie.prefix_trie(frame), *NODE) == sorted(brute_force_trie(turns), key=str)


def test_trie_without_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert trie.prefix_trie(nobody).count() == 0


def test_hashes_that_always_meet_fail(spark, monkeypatch):
    monkeypatch.setattr(trie, "ATTEMPTS", 1)
    turns = [(1, k, "user", str(k)) for k in range(8)]
    with pytest.raises(RuntimeError, match="met"):
        trie.prefix_trie(spark.createDataFrame(turns, TURNS), bits=1)


def test_products_compose():
    rnd = np.random.default_rng(1)
    a, b = (rnd.integers(0, trie.PRIME, 50).astype(np.uint64) for _ in range(2))
    assert trie.times(a, b).tolist() == [x * y % trie.PRIME for x, y in zip(a.tolist(), b.tolist())]
    length = rnd.integers(0, 10**6, 50)
    base = 12345678901234567
    joined = trie.joined_products(a, b, base, length)
    assert joined.tolist() == [
        (x * pow(base, n, trie.PRIME) + y) % trie.PRIME for x, y, n in zip(a.tolist(), b.tolist(), length.tolist())
    ]
    assert (trie.without_head(joined, a, base, length) == b).all()
    one = trie.Hashes.of_attempt(0, 61)
    assert one.turn("ab", "c") != one.turn("a", "bc")
