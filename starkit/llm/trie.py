"""The prefix trie of conversations that are rebuilt from a shared head and an own rest.

A sequence of turns has a fingerprint that composes: with element hashes t and a base b, it
is the product t1*b^(n-1) + ... + tn modulo a prime, and that of two sequences in a row is
``first * b^len(second) + second``. So the prefixes of a rebuilt conversation, its base's
head followed by its own turns, are computed from the products of both conversations as
they are stored. No rebuilt text is ever made.

1. Turns are sorted by conversation and place over all tasks. Each task multiplies the runs
   in its share; products of the few runs that go on in the next task are carried over.
   So a conversation with a large part of all turns is no single task's work.
2. Every rebuilt prefix is a row ``(conv_id, depth, fingerprint)`` with a reference to the
   stored turn that ends it; rows of equal depth and fingerprint are one node.
3. Equality is verified. All stored turns with one element hash must have the same role and
   text, and all turns that references of one node lead to must have the same hash. Then equal
   fingerprints have equal last turns and equal fingerprints before them, down to the root.
   Where either fails, everything is done again with other hashes.
4. Sums over subtrees come from pointer doubling: in each round a node hands on what it
   has gathered to the ancestor twice as far away, which its representative's own prefix
   names. The rounds grow with the logarithm of the depth; no path is expanded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm.common import slices, stored

# Rebuilt conversation c takes its head from conversation c - c % BASE_STEP.
BASE_STEP, HEADS = 20, 4
# The Mersenne prime modulo which products are taken, and the bits of a hash.
PRIME = (1 << 61) - 1
HASH_BITS = 61
ATTEMPTS = 4
# Ids of a node's conversations that are written as one text.
CHUNK_IDS = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = ["depth", "f1", "f2"]
_ROW_BITS = 33


class Hashes(NamedTuple):
    """Two seeds for turns, two bases for products, and how many bits a turn's hash has."""

    seeds: tuple[int, int]
    bases: tuple[int, int]
    bits: int

    @classmethod
    def of_attempt(cls, attempt: int, bits: int) -> Hashes:
        def number(name: bytes, k: int) -> int:
            return xxhash.xxh64_intdigest(name, 2 * attempt + k)

        bases = tuple(2 + number(b"base", k) % (PRIME - 2) for k in (0, 1))
        return cls((number(b"turn", 0), number(b"turn", 1)), bases, HASH_BITS if attempt else bits)

    def turn(self, role: str, text: str) -> tuple[int, int]:
        """An element for a role and a text; the role's length keeps them apart."""
        head = role.encode()
        data = len(head).to_bytes(8, "little") + head + text.encode()
        first, second = (xxhash.xxh64_intdigest(data, seed) % PRIME for seed in self.seeds)
        return first >> (HASH_BITS - self.bits), second >> (HASH_BITS - self.bits)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo ``PRIME`` in halves of 31 bits, for numbers below it."""
    low, mid_low = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    a_high, a_low, b_high, b_low = a >> np.uint64(31), a & low, b >> np.uint64(31), b & low
    mid = a_low * b_high + a_high * b_low
    total = ((a_high * b_high) << np.uint64(1)) + (mid >> np.uint64(30))
    return reduced(total + ((mid & mid_low) << np.uint64(31)) + a_low * b_low)


def reduced(total: np.ndarray) -> np.ndarray:
    total = (total & np.uint64(PRIME)) + (total >> np.uint64(61))
    return np.where(total >= np.uint64(PRIME), total - np.uint64(PRIME), total)


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo ``PRIME`` for each exponent."""
    found, square, left = np.ones(len(exponents), np.uint64), base, exponents.astype(np.int64)
    while left.any():
        odd = (left & 1).astype(bool)
        found[odd] = times(found[odd], np.full(int(odd.sum()), square, np.uint64))
        square, left = square * square % PRIME, left >> 1
    return found


def joined_products(first: np.ndarray, second: np.ndarray, base: int, length: np.ndarray) -> np.ndarray:
    """The product of two sequences in a row, the second of ``length`` turns."""
    return reduced(times(first, powers(base, length)) + second)


def without_head(whole: np.ndarray, head: np.ndarray, base: int, length: np.ndarray) -> np.ndarray:
    """The product of the last ``length`` turns, from those of all turns and of the others."""
    return reduced(whole + np.uint64(PRIME) - times(head, powers(base, length)))


def _words(text: str) -> int:
    return len(text.encode().split())  # at the contract's six bytes


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` of rows with a conversation; null texts are empty."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).filter(F.col("conv_id").isNotNull())


def _multiplied(turns: DataFrame, hashes: Hashes) -> DataFrame:
    """Stored rows ``(ref, conv_id, part, place, t1, t2, p1, p2, words, role, text)`` in order:
    place and products count from the beginning of the conversation in this ``part``."""
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, first, second = None, 0, 0, 0
        (b1, b2), turn_hash = hashes.bases, hashes.turn
        for batch in slices(batches):
            rows = []
            columns = (batch[name].to_pylist() for name in ("conv_id", "role", "text"))
            for conv_id, role, text in zip(*columns):
                if conv_id != conv:
                    conv, place, first, second = conv_id, 0, 0, 0
                t1, t2 = turn_hash(role, text)
                place, first, second = place + 1, (first * b1 + t1) % PRIME, (second * b2 + t2) % PRIME
                rows.append((place, t1, t2, first, second, _words(text)))
            numbers = np.array(rows, np.int64).reshape(-1, 6)
            made = [pa.array(numbers[:, k]) for k in range(6)]
            kept = [batch[name] for name in ("ref", "conv_id", "role", "text")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *made], names=["ref", "conv_id", "role", "text", "place", "t1", "t2", "p1", "p2", "words"]
            )

    numbered = ranged.withColumn("ref", F.monotonically_increasing_id())
    made = numbered.select("ref", "conv_id", "role", "text").mapInArrow(
        run,
        "ref bigint, conv_id bigint, role string, text string, place bigint, t1 bigint, t2 bigint, "
        "p1 bigint, p2 bigint, words bigint",
    )
    return stored(made, "turns").withColumn("part", F.shiftright("ref", _ROW_BITS))


def _carried(rows: DataFrame, hashes: Hashes) -> DataFrame:
    """Place and products from the beginning of each conversation. What reaches the driver
    is two ids for each partition, and two products for each that goes on in another."""
    spark = rows.sparkSession
    ends = rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).collect()
    ends.sort(key=lambda row: row["part"])
    over = sorted({a["high"] for a, b in zip(ends, ends[1:]) if a["high"] == b["low"]})
    rows = rows.drop("role", "text")
    if not over:
        return rows.drop("part")
    last = F.max(F.struct("place", "p1", "p2")).alias("last")
    runs = rows.filter(F.col("conv_id").isin(over)).groupBy("conv_id", "part").agg(last).collect()
    carries, conv, state = [], None, (0, 0, 0)
    for run in sorted(runs, key=lambda r: (r["conv_id"], r["part"])):
        state = state if run["conv_id"] == conv else (0, 0, 0)
        conv, length = run["conv_id"], run["last"]["place"]
        carries.append((conv, run["part"], *state))
        products = (
            (value * pow(base, length, PRIME) + run["last"][name]) % PRIME
            for value, base, name in zip(state[1:], hashes.bases, ("p1", "p2"))
        )
        state = (state[0] + length, *products)
    carry = spark.createDataFrame(carries, "conv_id bigint, part bigint, before bigint, c1 bigint, c2 bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch["place"].to_numpy()
            columns = {name: batch[name] for name in batch.schema.names}
            for name, head, base in zip(("p1", "p2"), ("c1", "c2"), hashes.bases):
                product = joined_products(_numbers(batch[head]), _numbers(batch[name]), base, place)
                columns[name] = pa.array(product.view(np.int64))
            columns["place"] = pa.array(place + batch["before"].to_numpy())
            for name in ("before", "c1", "c2"):
                del columns[name]
            yield pa.RecordBatch.from_pydict(columns)

    joined = rows.join(F.broadcast(carry), ["conv_id", "part"], "left").drop("part")
    joined = joined.fillna(0, ["before", "c1", "c2"])
    wanted = [(n, t) for n, t in joined.dtypes if n not in ("before", "c1", "c2")]
    return joined.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in wanted))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def head_turns(conv_id: Column) -> Column:
    """How many turns of its base a rebuilt conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _conversations(own: DataFrame) -> DataFrame:
    """Stored rows ``(conv_id, base, h, m, rebuilt, o1, o2, b1, b2)``: turns of the base's head
    and how many of them there are, turns rebuilt in all, and the products of the first
    ``h`` own turns and of the first ``m`` of the base."""
    h = head_turns(F.col("conv_id"))
    at_head = F.col("place") == h
    convs = own.groupBy("conv_id").agg(
        F.max("place").alias("length"),
        *[F.coalesce(F.max(F.when(at_head, F.col(p))), F.lit(0)).alias(o) for p, o in (("p1", "o1"), ("p2", "o2"))],
    )
    convs = convs.select("*", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASE_STEP).alias("base"))
    convs = stored(convs, "conversations")
    # A base's head has at most three turns.
    heads = own.filter((F.col("conv_id") % BASE_STEP == 0) & (F.col("place") < HEADS))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.max("place").alias("held"),
        F.map_from_entries(F.collect_list(F.struct("place", F.struct("p1", "p2")))).alias("products"),
    )
    m = F.least("h", F.coalesce("held", F.lit(0)))
    product = F.when(F.col("m") > 0, F.try_element_at("products", F.col("m")))
    return convs.join(heads, "base", "left").withColumn("m", m).select(
        "conv_id",
        "base",
        "h",
        "m",
        (F.col("m") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("rebuilt"),
        "o1",
        "o2",
        F.coalesce(product["p1"], F.lit(0)).alias("b1"),
        F.coalesce(product["p2"], F.lit(0)).alias("b2"),
    )


_PREFIX = ["conv_id", "depth", "f1", "f2", "t1", "t2", "words", "is_end"]


def rebuilt_prefixes(own: DataFrame, convs: DataFrame, hashes: Hashes) -> DataFrame:
    """``(conv_id, depth, f1, f2, t1, t2, words, is_end)`` of every prefix of every rebuilt
    conversation, the empty one included."""
    zeros = [F.lit(0).cast("bigint").alias(name) for name in ("depth", "f1", "f2", "t1", "t2", "words")]
    root = convs.select("conv_id", *zeros, (F.col("rebuilt") == 0).alias("is_end"))
    heads = own.filter((F.col("conv_id") % BASE_STEP == 0) & (F.col("place") < HEADS)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), F.col("p1").alias("f1"),
        F.col("p2").alias("f2"), "t1", "t2", "words",
    )
    head = convs.filter("m > 0").join(heads, "base").filter(F.col("depth") <= F.col("m"))
    head = head.withColumn("is_end", F.col("depth") == F.col("rebuilt")).select(*_PREFIX)
    rest = own.join(convs.drop("base"), "conv_id").filter(F.col("place") > F.col("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["place"].to_numpy() - batch["h"].to_numpy()
            depth = batch["m"].to_numpy() + length
            prints = []
            for whole, head, begin, base in zip(("p1", "p2"), ("o1", "o2"), ("b1", "b2"), hashes.bases):
                suffix = without_head(_numbers(batch[whole]), _numbers(batch[head]), base, length)
                prints.append(joined_products(_numbers(batch[begin]), suffix, base, length))
            columns = [batch["conv_id"], pa.array(depth), *(pa.array(f.view(np.int64)) for f in prints)]
            columns += [batch["t1"], batch["t2"], batch["words"]]
            columns.append(pa.array(depth == batch["rebuilt"].to_numpy()))
            yield pa.RecordBatch.from_arrays(columns, names=_PREFIX)

    rest = rest.mapInArrow(
        run,
        "conv_id bigint, depth bigint, f1 bigint, f2 bigint, t1 bigint, t2 bigint, words bigint, is_end boolean",
    )
    return root.union(head).union(rest)


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)``: the digest of each node's ids in order, joined by
    commas. Ids become texts where they lie, many tasks to a node; a node's task then only
    runs over texts of ``CHUNK_IDS`` ids, one at a time."""
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = "depth bigint, f1 bigint, f2 bigint"

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            depth, f1, f2, ids = (batch[name].to_numpy() for name in (*_NODE, "conv_id"))
            same = (depth[1:] == depth[:-1]) & (f1[1:] == f1[:-1]) & (f2[1:] == f2[:-1])
            cuts = np.flatnonzero(~same) + 1
            starts = np.concatenate([[0], cuts])
            pieces = [
                (start, ",".join(map(str, ids[at : min(at + CHUNK_IDS, end)].tolist())), at)
                for start, end in zip(starts.tolist(), [*cuts.tolist(), len(ids)])
                for at in range(start, end, CHUNK_IDS)
            ]
            at = [p[2] for p in pieces]
            columns = [pa.array(c[at]) for c in (depth, f1, f2, ids)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([p[1] for p in pieces])], names=[*_NODE, "first_id", "ids"]
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def found(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=[*_NODE, "ends_sha256"])

        for batch in slices(batches):
            rows = []
            for *key, ids in zip(*(batch[name].to_pylist() for name in (*_NODE, "ids"))):
                if key == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield found(rows)
        if node is not None:
            yield found([(*node, digest.hexdigest())])

    order = [*_NODE, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    chunks = ranged.mapInArrow(texts, f"{key}, first_id bigint, ids string")
    dealt = chunks.repartition(tasks, *_NODE).sortWithinPartitions(*_NODE, "first_id")
    return dealt.select(*_NODE, "ids").mapInArrow(digests, f"{key}, ends_sha256 string")


def _same_turns(rows: DataFrame) -> bool:
    """Whether all stored turns of one hash have one role and one text."""
    kinds = rows.groupBy("t1", "t2").agg(
        *[f(c).alias(f"{c}_{k}") for c in ("role", "text") for k, f in enumerate((F.min, F.max))]
    )
    return kinds.filter("role_0 != role_1 OR text_0 != text_1").isEmpty()


def _nodes(prefixes: DataFrame, hashes: Hashes) -> DataFrame:
    """Nodes with their smallest member, members, turn, and their parent's fingerprint."""
    nodes = prefixes.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        *[f(c).alias(f"{c}{end}") for c in ("t1", "t2") for f, end in ((F.max, ""), (F.min, "_least"))],
    )
    inverses = [pow(base, -1, PRIME) for base in hashes.bases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, turn, above, inverse in zip(("f1", "f2"), ("t1", "t2"), ("u1", "u2"), inverses):
                rest = reduced(_numbers(batch[name]) + np.uint64(PRIME) - _numbers(batch[turn]))
                product = times(rest, np.full(len(rest), inverse, np.uint64))
                batch = batch.append_column(above, pa.array(product.view(np.int64)))
            yield batch

    schema = ", ".join(f"{n} {t}" for n, t in nodes.dtypes)
    return nodes.mapInArrow(run, f"{schema}, u1 bigint, u2 bigint")


def _subtree_sums(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(depth, f1, f2, n_leaves, saved_tokens)`` summed over each node's subtree."""
    names = ["n_leaves", "saved_tokens"]
    sums = nodes.select(*_NODE, "conv_id", *names)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    places = prefixes.select("conv_id", "depth", "f1", "f2")
    step = 1
    while step <= deepest:
        moved = sums.filter(F.col("depth") >= step).select(
            "conv_id", (F.col("depth") - step).alias("depth"), *names
        )
        arrived = moved.join(places, ["conv_id", "depth"]).groupBy(*_NODE).agg(
            *[F.sum(name).alias(f"more_{name}") for name in names]
        )
        added = [(F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names]
        sums = stored(sums.join(arrived, _NODE, "left").select(*_NODE, "conv_id", *added), "subtree-sums")
        step *= 2
    return sums.select(*_NODE, *names)


def prefix_trie(conversations: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)`` of every node; ``conv_id`` is the smallest member.

    Turns are ordered by ``turn``, a null one first, and among equals by role and text;
    repeated rows are turns of their own. Null roles and texts are empty, texts of any length
    are turns like others. Rows without ``conv_id`` belong to no conversation. A table without
    conversations has no root and gives no rows. Other columns are not read. ``bits`` are those
    of a turn's hash in the first attempt.
    """
    spark: SparkSession = conversations.sparkSession
    for attempt in range(ATTEMPTS):
        hashes = Hashes.of_attempt(attempt, bits)
        rows = _multiplied(turns_of(conversations), hashes)
        if not _same_turns(rows):
            continue
        own = _carried(rows, hashes)
        convs = stored(_conversations(own), "heads")
        prefixes = stored(rebuilt_prefixes(own, convs, hashes), "prefixes")
        nodes = stored(_nodes(prefixes, hashes), "nodes")
        if nodes.filter("t1 != t1_least OR t2 != t2_least").isEmpty():
            return _described(nodes, prefixes)
    raise RuntimeError(f"{spark.sparkContext.appName}: fingerprints met in {ATTEMPTS} attempts")


def _described(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    below = nodes.filter("depth > 0")
    above = [(F.col("depth") - 1).alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2")]
    children = stored(below.select(*above).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children")), "children")
    counted = nodes.join(children, _NODE, "left").fillna(0, ["n_children"])
    counted = counted.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    counted = stored(counted, "counted-nodes")
    sums = _subtree_sums(counted, prefixes)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("f1").alias("u1"),
        F.col("f2").alias("u2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    digests = stored(ends_digest(prefixes.filter("is_end")), "ends")
    return (
        counted.drop("n_leaves", "saved_tokens")
        .join(sums, _NODE)
        .join(digests, _NODE, "left")
        .join(parents, ["depth", "u1", "u2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
