"""Encoding, packing, matrices, substrings, near-duplicates, host rules: brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from starkit.llm import binary, bpe, hosts, packing, queries, simhash, substrings
from starkit.llm.pieces import cut_documents
from starkit.llm.components import connected_components

PASSAGE = " ".join(f"shared{k}" for k in range(60))
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# BPE -----------------------------------------------------------------------


def random_texts():
    rnd = random.Random(5)
    alphabet = " \n\t\r\x0b\x1c\x85 　ab'sStTΣσİßéñ1２٣.,$🙂漢字́​"
    made = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 30))) for _ in range(3000)]
    return made + ["a" * 700, "ab" * 300 + "<|endoftext|> x", "<|endoftext|>" * 3, "x\n \ny", " ", "  a "]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    with open(path, "rb") as file:
        mine = bpe.Bpe(file.read())
    library, texts = Tokenizer.from_file(path), random_texts()
    for text, packed in zip(texts, mine.encode_all(texts)):
        ids = np.frombuffer(packed, mine.dtype).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_scan_and_heap_agree():
    with open(BYTE, "rb") as file:
        mine = bpe.Bpe(file.read())
    for word in ("internationalisation", "aaaaaaaaaaaab", "thethethe", "x"):
        parts = [mine._first[b] for b in word.encode()]
        scan = np.frombuffer(mine._merge_by_scan([word.encode()], 32)[0], mine.dtype)
        assert mine._merge_with_heap(parts) == scan.tolist()


def test_memo_keeps_results_when_it_turns():
    with open(BYTE, "rb") as file:
        mine = bpe.Bpe(file.read())
    mine._word_ids._half = mine._chunk_ids._half = 5
    texts = random_texts()[:200]
    first = [mine.encode(text) for text in texts]
    assert first == [mine.encode(text) for text in texts] == mine.encode_all(texts)


def test_decoding_replaces_broken_bytes_like_the_library():
    with open(BYTE, "rb") as file:
        mine = bpe.Bpe(file.read())
    library, rnd = Tokenizer.from_file(BYTE), random.Random(1)
    lists = [[rnd.randrange(50257) for _ in range(rnd.randint(0, 6))] for _ in range(500)] + [None]
    found = mine.decode_all(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert found == [library.decode(ids or [], skip_special_tokens=False) for ids in lists]


def test_encode_and_decode_awkward_rows(awkward, empty):
    library = Tokenizer.from_file(BYTE)
    decoded = bpe.decode(bpe.encode(awkward, BYTE), BYTE)
    found = sorted_rows(decoded, "doc_id", "ids", "text")
    wanted = [
        (r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids, r["text"] or "")
        for r in awkward.collect()
    ]
    assert found == sorted(wanted, key=str)
    assert bpe.decode(bpe.encode(empty, BYTE), BYTE).count() == 0


# Packing and matrices --------------------------------------------------------


def wanted_pieces(docs, capacity):
    library, pieces = Tokenizer.from_file(WORD), []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            pieces.append((r["doc_id"], number, start, len(part), zlib.crc32(part)))
    return sorted(pieces, key=str)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_is_lossless_and_gapless(awkward, empty, capacity):
    packed = packing.pack_documents(awkward, WORD, capacity)
    assert sorted_rows(packed, "doc_id", "piece", "start", "length", "ids_crc32") == wanted_pieces(awkward, capacity)
    sequences = {}
    for r in packed.collect():
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert packing.pack_documents(empty, WORD).count() == 0


def test_packing_of_many_groups_loses_few_sequences(spark):
    rnd = random.Random(2)
    lengths = [min(1000, int(rnd.lognormvariate(5, 1))) or 1 for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    packed = packing.pack(items, 1000, group_pieces=200).toPandas()
    assert sorted(packed["item"]) == list(range(4000))
    fills = packed.assign(length=[lengths[i] for i in packed["item"]]).groupby("sequence_id")["length"].sum()
    assert fills.max() <= 1000
    assert len(fills) <= -(-sum(lengths) // 1000) + 2


def test_pieces_too_long_to_share_end_the_levels(spark):
    items = spark.createDataFrame([(i, 600) for i in range(500)], "item long, length long")
    packed = packing.pack(items, 1000, group_pieces=100)
    assert packed.select("sequence_id").distinct().count() == packed.count() == 500


@pytest.mark.parametrize("lengths", [[300] * 1010, [600, 230] * 505])
def test_bins_that_are_never_well_filled_are_mended_across_groups(spark, lengths):
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    packed = packing.pack(items, 1000, group_pieces=100).toPandas()
    assert sorted(packed["item"]) == list(range(1010))
    fills = packed.assign(length=[lengths[i] for i in packed["item"]]).groupby("sequence_id")["length"].sum()
    assert fills.max() <= 1000
    # Three of 300 fill 0.9 of a bin; one of 600 and one of 230 fill 0.83.
    assert len(fills) <= (-(-1010 // 3) if lengths[1] == 300 else 505) + 2


def test_genetic_operators_keep_every_piece():
    random_ = np.random.default_rng(3)
    lengths = random_.integers(100, 700, 300)
    population = packing.first_population(lengths, 1000, 4, random_)
    assert len(population) > 1
    child = packing.crossover(population[0], population[1], lengths, 1000, random_)
    child = packing.mutation(child, lengths, 1000, random_)
    for one in [child, *packing.evolve(population, lengths, 1000, 20, random_)]:
        assert (np.bincount(one.bins, lengths, len(one.fills)) == one.fills).all()
        assert one.fills.max() <= 1000
    best = packing.evolve(population, lengths, 1000, 20, random_)[0]
    assert best.fitness(1000) >= max(p.fitness(1000) for p in population)


def test_segment_tree_finds_the_fullest_sequence():
    rnd = np.random.default_rng(4)
    lengths = rnd.integers(1, 100, 500)
    found = binary.best_fit_decreasing(lengths, 100)
    fills = []
    for length in sorted(lengths.tolist(), reverse=True):  # plain best fit
        rooms = [(100 - fill, k) for k, fill in enumerate(fills) if fill + length <= 100]
        if rooms:
            fills[min(rooms)[1]] += length
        else:
            fills.append(length)
    assert sorted(np.bincount(found, lengths)) == sorted(fills)


def test_matrices_hold_every_id_and_restart_positions(awkward, empty):
    rows = binary.matrices(awkward, WORD, 64)
    segments = []
    for r in rows.collect():
        ids, ends = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["cu_seqlens"], "<i4")
        positions = np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(positions) == 64 and ends[0] == 0 and ends[-1] == r["n_tokens"]
        assert not ids[ends[-1] :].any()
        for doc_id, piece, a, b in zip(r["doc_ids"], r["pieces"], ends, ends[1:]):
            segments.append((doc_id, piece, 64 * piece, b - a, zlib.crc32(ids[a:b].astype("<u4"))))
            assert (positions[a:b] == np.arange(b - a)).all()
        assert (positions[ends[-1] :] == np.arange(64 - ends[-1])).all()
    assert sorted(segments, key=str) == wanted_pieces(awkward, 64)
    assert binary.matrices(empty, WORD).count() == 0


def test_matrices_are_written_as_they_are(awkward, tmp_path):
    rows = binary.matrices(awkward, WORD)
    binary.write_matrices(rows, str(tmp_path / "out"))
    back = awkward.sparkSession.read.parquet(str(tmp_path / "out"))
    assert sorted_rows(back, "sequence_id", "ids") == sorted_rows(rows, "sequence_id", "ids")


def test_the_query_takes_its_digests_from_written_matrices(spark, awkward, tmp_path, monkeypatch):
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    paths, write = [], binary.write_matrices
    monkeypatch.setattr(binary, "write_matrices", lambda rows, path: (paths.append(path), write(rows, path)))
    found = {r["sequence_id"]: r for r in queries.op7_binary(spark, str(tmp_path)).collect()}
    assert len(paths) == 1
    back = spark.read.parquet(paths[0]).collect()
    assert len(back) == len(found) > 0
    for r in back:
        assert len(r["ids"]) == 2 * 4096
        for column in ("ids", "cu_seqlens", "position_ids"):
            assert zlib.crc32(r[column]) == found[r["sequence_id"]][f"{column}_crc32"]


# Substrings ------------------------------------------------------------------


def brute_force_repeats(pairs, window):
    """Per row: words, and which are removed. A null id comes last and owns nothing."""
    owners = {}
    for doc_id, text in pairs:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if doc_id is not None:
                owners[key] = min(owners.get(key, doc_id), doc_id)
    for doc_id, text in pairs:
        w, removed = words(text), set()
        for k in range(len(w) - window + 1):
            owner = owners.get(tuple(w[k : k + window]))
            if owner is not None and (doc_id is None or owner < doc_id):
                removed.update(range(k, k + window))
        yield doc_id, w, removed


@pytest.mark.parametrize("window, hot", [(50, 1000), (5, 1000), (5, 3), (1, 1000)])
def test_removal_against_brute_force(awkward, monkeypatch, window, hot):
    monkeypatch.setattr(substrings, "HOT_DOCUMENTS", hot)
    pairs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    wanted = [
        (i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone))
        for i, w, gone in brute_force_repeats(pairs, window)
    ]
    found = substrings.remove_repeats(awkward, window)
    assert sorted_rows(found, "doc_id", "kept_text", "n_words", "n_removed") == sorted(wanted, key=str)
    cut = substrings.without_repeats(awkward, window)
    assert cut.columns == awkward.columns
    assert sorted((i, words(t)) for i, t in cut.select("doc_id", "text").collect() if i) == sorted(
        (i, words(t)) for i, t, *_ in wanted if i
    )


def test_a_crowded_sketch_loses_nothing(awkward):
    few = substrings.remove_repeats(awkward, 5, cells=1 << 16)
    many = substrings.remove_repeats(awkward, 5, cells=1 << 22)
    assert sorted_rows(few, *few.columns) == sorted_rows(many, *many.columns)


def test_unchanged_text_keeps_its_white_space(awkward, empty):
    before = {(r["doc_id"], r["text"]) for r in awkward.collect()}
    after = substrings.without_repeats(awkward).select("doc_id", "text").collect()
    assert (8, dict(after)[8]) in before and (None, None) in {tuple(r) for r in after}
    assert (3, "other words\tahead\nand  more") in {tuple(r) for r in after}
    assert substrings.without_repeats(empty).count() == substrings.remove_repeats(empty).count() == 0


def same_crc(first, second):
    """Endings that give texts with these beginnings one CRC-32."""

    def ended(text, k):
        return f"{text} {hashlib.md5(str(k).encode()).hexdigest()[:12]}"

    seen = {zlib.crc32(ended(first, k).encode()): ended(first, k) for k in range(200_000)}
    tries = (ended(second, k) for k in range(1_000_000))
    return next((seen[crc], text) for text in tries if (crc := zlib.crc32(text.encode())) in seen)


def test_words_that_a_linear_hash_confuses_are_told_apart(spark):
    morse = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    rest = " ".join(f"w{k}" for k in range(49))
    other = morse.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{morse} {rest}"), (2, f"{other} {rest}")], "doc_id long, text string")
    assert [r["n_removed"] for r in substrings.remove_repeats(docs).collect()] == [0, 0]


def test_words_at_the_edges_of_the_hash(spark):
    # Lengths around the eight bytes read at a time and the limit of long words.
    heads = [x * n for x in "ab" for n in (1, 7, 8, 9, 15, 16, 17, 255, 256, 257, 5000)]
    pairs = [(k, f"{head} tail") for k, head in enumerate(heads)]
    pairs += [(100 + k, f"{head} tail") for k, head in enumerate(heads)]
    found = substrings.remove_repeats(spark.createDataFrame(pairs, "doc_id long, text string"), 2)
    assert {(r["doc_id"] >= 100, r["n_removed"]) for r in found.collect()} == {(False, 0), (True, 2)}


def test_rows_without_id_whose_texts_share_a_crc(spark):
    long, short = same_crc(f"head {PASSAGE}", "a short one")
    pairs = [(1, f"first {PASSAGE}"), (None, long), (None, short)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    found = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substrings.remove_repeats(docs).collect()}
    assert found == {(1, 61): 0, (None, 62): 60, (None, 4): 0}
    cut = {r["text"] for r in substrings.without_repeats(docs).collect()}
    assert short in cut and f"first {PASSAGE}" in cut


def test_a_row_of_many_windows_is_cut(spark, monkeypatch):
    monkeypatch.setattr(substrings, "ROW_WINDOWS", 3)
    text = " ".join(f"w{k % 7}" for k in range(400))
    docs = spark.createDataFrame([(1, text), (2, f"x {text} y")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(docs, 9).collect()) == [
        (1, 0),
        (2, 400),
    ]


# Near-duplicates -------------------------------------------------------------


def brute_force_simhash(text, size):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force_components(values, distance):
    parent = list(range(len(values)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(k) for k in range(len(values))]


def test_fingerprints_and_components_of_awkward_rows(awkward, empty):
    rows = awkward.select("doc_id", "text").collect()
    prints = [brute_force_simhash(t, 4) for _, t in rows]
    roots = brute_force_components(prints, 4)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    wanted = [(i, p - (p >> 63 << 64), least[r]) for (i, _), p, r in zip(rows, prints, roots)]
    found = simhash.near_duplicates(awkward)
    assert sorted_rows(found, "doc_id", "fingerprint", "component_id") == sorted(wanted, key=str)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("distance, limit, chunk", [(4, 4096, 2048), (4, 40, 16), (7, 40, 16), (3, 4096, 64)])
def test_links_against_all_pairs(spark, distance, limit, chunk):
    rnd, values = random.Random(distance), set()
    for _ in range(40):
        center = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 5, 60])):
            bits = rnd.sample(range(64), rnd.randint(0, 5))
            values.add(center ^ sum(1 << b for b in bits))
    values = sorted(v - (v >> 63 << 64) for v in values)
    roots = brute_force_components([v & (1 << 64) - 1 for v in values], distance)
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = simhash.linked(prints, distance, limit, chunk)
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    wanted = {}
    for value, root in zip(values, roots):
        wanted.setdefault(root, []).append(value)
    assert {v: min(g) for g in wanted.values() for v in g if v != min(g)} == found
    # A bucket of n fingerprints gives at most n links in a task, not all pairs.
    assert links.count() <= 64 * len(values)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    links = [*chain, *((1, k) for k in range(2, 40)), (50, 50), (-7, 60), (60, -7), (60, 61)]
    found = connected_components(spark.createDataFrame(links, "node long, other long"))
    wanted = {k: 100 for k in range(101, 161)} | {k: 1 for k in range(2, 40)} | {60: -7, 61: -7}
    assert {r["node"]: r["root"] for r in found.collect()} == wanted
    nothing = spark.createDataFrame([], "node long, other long")
    assert connected_components(nothing).count() == 0


def test_one_of_each_group_stays(awkward, empty):
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    marked = [(i, t, brute_force_simhash(t, 4)) for i, t in awkward.select("doc_id", "text").collect()]
    roots = brute_force_components([p for _, _, p in marked], 4)
    best = {}
    for (doc_id, text, _), root in zip(marked, roots):
        key = (doc_id is None, doc_id or 0, zlib.crc32(text.encode()) if text is not None else -1)
        best[root] = min(best.get(root, key), key)
    found = [
        (r["doc_id"] is None, r["doc_id"] or 0, zlib.crc32(r["text"].encode()) if r["text"] is not None else -1)
        for r in kept.collect()
    ]
    assert sorted(found) == sorted(best.values())
    assert simhash.keep_first(empty).count() == 0


def test_rows_that_share_a_crc_are_not_repeats(spark):
    one, other = same_crc("alpha beta gamma delta", "four words of another kind")
    pairs = [(5, "something else altogether here"), (None, one), (None, other), (None, f"{one} x")]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    kept = {r["text"] for r in simhash.keep_first(docs).collect()}
    prints = [brute_force_simhash(t, 4) for _, t in pairs]
    assert len(set(brute_force_components(prints, 4))) == len(kept)
    assert {"something else altogether here", one, other} <= kept


def test_one_of_many_repeated_rows_without_id_stays(spark):
    pairs = [(None, f"copy of the very same {PASSAGE}")] * 2000 + [(1, "a text of its own")]
    kept = simhash.keep_first(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    assert sorted(len(r["text"]) for r in kept) == sorted({len(t) for _, t in pairs})


# Host rules ------------------------------------------------------------------


def brute_force_measures(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    often = {p for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(often)


def test_measures_and_verdicts_of_awkward_rows(awkward, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = sorted_rows(hosts.judged(awkward), "doc_id", *names, "base_failed")
    wanted = []
    for doc_id, text in awkward.select("doc_id", "text").collect():
        m = brute_force_measures(text)
        wanted.append((doc_id, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert found == sorted(wanted, key=str)
    assert hosts.judged(empty).count() == hosts.keep_good(empty).count() == 0


def test_the_stage_measures_texts_once(spark, awkward, monkeypatch):
    calls, measures = [], hosts.measures
    monkeypatch.setattr(hosts, "measures", lambda text: (calls.append(1), measures(text))[1])
    kept = hosts.keep_good(awkward)
    assert kept.columns == awkward.columns and len(calls) == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "regexp_count" not in plan
    wanted = hosts.judged(awkward).filter("kept")
    assert sorted_rows(kept, "doc_id") == sorted_rows(wanted, "doc_id")


def test_host_with_many_failures_loses_good_documents(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    pairs = [("bad", "short")] * 45 + [("bad", good)] * 5 + [("fine", good)] * 50 + [(None, good)]
    pairs += [("small", "short"), ("small", good)]
    docs = spark.createDataFrame([(k, t, s) for k, (s, t) in enumerate(pairs)], "doc_id long, text string, source string")
    kept = {(r["host"], r["kept"]) for r in hosts.judged(docs).filter("not base_failed").collect()}
    assert ("bad", False) in kept and ("fine", True) in kept and (None, True) in kept
    same = hosts.keep_good(docs)
    assert sorted_rows(same, "doc_id") == sorted_rows(hosts.judged(docs).filter("kept"), "doc_id")


def test_shrunk_rates(spark):
    rated = spark.createDataFrame([("a", True)] * 3 + [("a", False)] + [("b", False)] * 8, "host string, failed boolean")
    rates = {r["host"]: r["shrunk_rate"] for r in hosts.host_verdicts(rated).collect()}
    mean, spread = 0.375, 0.140625
    strength = max(1.0, mean * (1 - mean) / spread - 1)
    assert rates["a"] == pytest.approx((3 + mean * strength) / (4 + strength))
    assert rates["b"] == pytest.approx(mean * strength / (8 + strength))


def test_digest_of_cut_documents(awkward):
    pieces = cut_documents(awkward, WORD, 64, with_ids=True).collect()
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u2").astype("<u4")
        assert zlib.crc32(ids) == r["ids_crc32"] and len(ids) == r["length"]
    assert hashlib.sha256(b"".join(r["ids"] for r in pieces)).hexdigest()
