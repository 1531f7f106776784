"""Near-duplicate documents by SimHash with deletion-variant signatures.

Fingerprints that differ in at most ``distance`` bits are linked. They are cut into so few
segments that one of them differs by at most one bit. Each segment is indexed once for
each of its bits with that bit left out; two segments that differ by at most one bit share
such a variant. An equality join on the variants finds every pair, which is verified.

Fingerprints are made distinct first, so copies meet once. The variants of a task come
sorted, bucket by bucket. A task verifies the pairs of a bucket in small blocks and hands
on a link only if it joins two groups that its links have not yet joined; a bucket
of many fingerprints is cut into chunks, and pairs of chunks are verified by other tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import documents, fresh_name, slices, stored
from starkit.llm.components import connected_components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
BITS = 64
# Buckets of up to so many fingerprints are verified together.
FEW = 32
# Fingerprints of a bucket that one task verifies; more are dealt out in chunks.
BUCKET_LIMIT = 4096
CHUNK = 2048

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS) -> bytes:
    """XXH64 of every shingle of a text, 8 bytes each; none if it has no word."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return b""
    data = b" ".join(parts)
    # Where each word begins and ends in ``data``.
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(data[a:b], SEED) for a, b in zip(starts, ends)])


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text; zero if it has no word."""
    hashes = shingle_hashes(text, words)
    counts = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for begin in range(0, len(rows), 1 << 16):  # bounds the unpacked bits of a long text
        counts += np.unpackbits(rows[begin : begin + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fingerprint bigint)`` of every whole text: A-Z lower-cased, shingles of
    ``words`` words with repeats, XXH64 of each. Fewer words are one shingle; a null text
    or one without a word has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([simhash(text, words) for text in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return documents(docs).mapInArrow(run, "doc_id bigint, fingerprint bigint")


def segments(distance: int) -> list[tuple[int, int]]:
    """``(first bit, bits)`` of as few segments as leave one with at most one error."""
    count = distance // 2 + 1
    edges = [BITS * k // count for k in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def variants(fingerprint: Column, distance: int) -> Column:
    """All one-wildcard variants: the wildcard's bit number, and the rest of its segment."""
    found = []
    for low, bits in segments(distance):
        for bit in range(low, low + bits):
            mask = ((1 << bits) - 1) << low & ~(1 << bit)
            signed = mask - (1 << 64) if mask >> 63 else mask
            rest = F.shiftrightunsigned(fingerprint.bitwiseAND(F.lit(signed).cast("bigint")), low)
            found.append(rest.bitwiseOR(F.lit(bit << 56).cast("bigint")))
    return F.array(*found)


class Groups:
    """Which fingerprints the links so far have joined."""

    def __init__(self) -> None:
        self._parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        parent = self._parent
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    def join(self, one: int, other: int) -> bool:
        a, b = self.find(one), self.find(other)
        if a != b:
            self._parent[max(a, b)] = min(a, b)
        return a != b

    def all_joined(self, nodes: list[int]) -> bool:
        root = self.find(nodes[0])
        return all(self.find(node) == root for node in nodes)


def _differing(bits: np.ndarray) -> np.ndarray:
    """Ones of each number; of signed numbers NumPy would count those of the magnitude."""
    return np.bitwise_count(bits.view(np.uint64))


def verified_links(
    first: np.ndarray, second: np.ndarray, distance: int, groups: Groups, block: int = 512
) -> Iterator[tuple[int, int]]:
    """Links between two arrays of fingerprints that join groups not joined before."""
    for a in range(0, len(first), block):
        left = first[a : a + block]
        for b in range(0, len(second), block):
            right = second[b : b + block]
            close = _differing(left[:, None] ^ right[None, :]) <= distance
            for i, j in zip(*np.nonzero(close)):
                one, other = int(left[i]), int(right[j])
                if one != other and groups.join(one, other):
                    yield one, other


def _close_neighbours(keys: np.ndarray, prints: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links within many small buckets at once: each with its next row, the one after, ..."""
    for step in range(1, FEW):
        together = np.flatnonzero(keys[:-step] == keys[step:])
        if not len(together):
            return
        left, right = prints[together], prints[together + step]
        close = (_differing(left ^ right) <= distance) & (left != right)
        yield from zip(left[close].tolist(), right[close].tolist())


def link_arrays(links: list[tuple[int, int]]) -> list[pa.Array]:
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


def links_of_buckets(indexed: DataFrame, distance: int, limit: int) -> DataFrame:
    """Rows ``(hot, node, other)``: links, or members ``other`` of a large bucket ``node``.

    ``indexed(variant, fingerprint)`` is dealt and sorted by variant.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Groups()
        keys, prints = np.empty(0, np.int64), np.empty(0, np.int64)

        def settled(last: bool) -> Iterator[pa.RecordBatch]:
            """All buckets but the last one, which the next batch may continue."""
            nonlocal keys, prints
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            links, members = [], []
            sizes = ends - starts
            few = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
            for one, other in _close_neighbours(keys[: len(few)][few], prints[: len(few)][few], distance):
                if groups.join(one, other):
                    links.append((one, other))
            for start, end in zip(starts[sizes > FEW].tolist(), ends[sizes > FEW].tolist()):
                bucket = prints[start:end]
                if end - start > limit:
                    members += [(int(keys[start]), value) for value in bucket.tolist()]
                elif not groups.all_joined(bucket.tolist()):
                    links += verified_links(bucket, bucket, distance, groups)
            done = int(ends[-1]) if len(ends) else 0
            keys, prints = keys[done:], prints[done:]
            for hot, rows in ((False, links), (True, members)):
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([hot] * len(rows)), *link_arrays(rows)],
                        names=["hot", "node", "other"],
                    )

        for batch in batches:
            keys = np.concatenate([keys, batch["variant"].to_numpy()])
            prints = np.concatenate([prints, batch["fingerprint"].to_numpy()])
            if len(keys) and keys[0] != keys[-1]:
                yield from settled(False)
        if len(keys):
            yield from settled(True)

    return indexed.mapInArrow(run, "hot boolean, node bigint, other bigint")


def links_of_chunks(members: DataFrame, distance: int, chunk: int) -> DataFrame:
    """Links inside large buckets ``(variant, fingerprint)``: every pair of chunks is one
    group of at most about two chunks, so no task gets a whole bucket."""
    counts = members.groupBy("variant").agg(
        F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    dealt = (
        members.join(counts, "variant")
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("own", "with"))
        .withColumn("high", F.greatest("own", "with"))
        .select("variant", "low", "high", "own", "fingerprint")
    )

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        prints, own = frame["fingerprint"].to_numpy(np.int64), frame["own"].to_numpy()
        first, second = prints[own == key[1]], prints[own == key[2]]
        links = list(verified_links(first, second, distance, Groups()))
        return pd.DataFrame(links, columns=["node", "other"], dtype=np.int64)

    return dealt.groupBy("variant", "low", "high").applyInPandas(run, "node bigint, other bigint")


def linked(
    prints: DataFrame,
    distance: int = DISTANCE,
    limit: int = BUCKET_LIMIT,
    chunk: int = CHUNK,
) -> DataFrame:
    """Links ``(node, other)`` that connect all fingerprints within ``distance``, directly or
    through others, from distinct ``prints(fingerprint)``."""
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fingerprints are small to read, but each becomes 64 variants: spread that work.
    spread = prints.select("fingerprint").repartition(tasks, "fingerprint")
    indexed = spread.select("fingerprint", F.explode(variants(F.col("fingerprint"), distance)).alias("variant"))
    dealt = indexed.select("variant", "fingerprint").repartition(tasks, "variant")
    found = stored(
        links_of_buckets(dealt.sortWithinPartitions("variant", "fingerprint"), distance, limit), "bucket-links"
    )
    members = found.filter("hot").select(
        F.col("node").alias("variant"), F.col("other").alias("fingerprint")
    )
    chunks = links_of_chunks(members, distance, chunk)
    return found.filter(~F.col("hot")).select("node", "other").union(chunks)


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, fingerprint bigint, component_id)`` of every row.

    ``component_id`` is the smallest doc_id of all documents that links reach. Documents
    with equal fingerprints are linked, those without a word among each other. A row
    without id is linked like any other but names no component; it is null where a
    component has no id at all. Repeated rows come once each; an empty table gives none.
    """
    marked = stored(fingerprints(docs, words), "fingerprints")
    named = grouped(marked, distance).select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def grouped(marked: DataFrame, distance: int) -> DataFrame:
    """``(fingerprint, root, component_id)`` of the distinct fingerprints of
    ``marked(doc_id, fingerprint)``; ``root`` is the same for all of a component."""
    prints = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"))
    prints = stored(prints, "distinct-prints")
    roots = connected_components(linked(prints.select("fingerprint"), distance))
    rooted = prints.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root"))
    rooted = stored(rooted, "rooted")
    names = stored(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    return stored(rooted.join(names, "root").drop("least_id"), "named")


def keep_first(docs: DataFrame, distance: int = DISTANCE, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs``, as they are, of which one stays for each group of
    near-duplicates, as ``keep_least`` states."""
    marked = stored(_fingerprints_with_keys(with_text_keys(docs), words), "fingerprints")
    named = grouped(marked, distance).select("fingerprint", "root")
    return keep_least(docs, marked.join(named, "fingerprint").select("doc_id", "text_key", "root"))


def with_text_keys(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, text_key)``; ``text_key`` stands for a row's text."""
    return docs.select(F.col("doc_id").cast("bigint"), "text", _text_key().alias("text_key"))


def _text_key() -> Column:
    """96 bits that stand for a text where rows share an id, or have none."""
    number = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(-1))
    return F.struct(number.alias("number"), F.xxhash64("text").alias("hash"))


def keep_least(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of ``docs``, as they are, of which one stays for each ``root`` of
    ``marked(doc_id, text_key, root)``: the smallest doc_id, and of rows that share it the
    smallest text number. A row without id stays only if its group has no row with one."""
    key, name, copy = (fresh_name(docs, n) for n in ("_text_key", "_kept_id", "_copy"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key"))
    kept = (
        marked.groupBy("root")
        .agg(first.alias("first"))
        .select(F.col("first.doc_id").alias(name), F.col("first.text_key").alias(f"{name}_text"))
    )
    kept = stored(kept, "kept")
    repeated = marked.groupBy("doc_id", "text_key").count().filter("count > 1")
    repeated = stored(repeated.join(kept, _same(F.col("doc_id"), F.col("text_key"), name), "left_semi"), "repeated")
    keyed = docs.withColumn(key, _text_key())
    stays = keyed.join(kept, _same(keyed["doc_id"].cast("bigint"), keyed[key], name), "left_semi")
    if repeated.isEmpty():
        return stays.drop(key)
    # Rows that repeat an id and a text: one of each stays.
    repeated = repeated.select(F.col("doc_id").alias(name), F.col("text_key").alias(f"{name}_text"))
    same = _same(stays["doc_id"].cast("bigint"), stays[key], name)
    order = Window.partitionBy("doc_id", key).orderBy(F.xxhash64(*docs.columns))
    one = stays.join(repeated, same, "left_semi").withColumn(copy, F.row_number().over(order))
    return stays.join(repeated, same, "left_anti").union(one.filter(F.col(copy) == 1).drop(copy)).drop(key)


def _same(doc_id: Column, text_key: Column, name: str) -> Column:
    return doc_id.eqNullSafe(F.col(name)) & (text_key == F.col(f"{name}_text"))


def _fingerprints_with_keys(ids: DataFrame, words: int) -> DataFrame:
    @F.pandas_udf("bigint")
    def marked(texts):
        import pandas as pd

        return pd.Series(np.array([simhash(text, words) for text in texts], np.uint64).view(np.int64))

    return ids.select("doc_id", "text_key", marked("text").alias("fingerprint"))
