"""Nearest neighbours by inner product: a block matrix join with quantised tiles.

Vectors are laid in blocks with an 8-bit copy, its scale, and the length of the
quantisation error. A task gets a block of queries and a block of candidates. The product
of their 8-bit tiles gives every inner product up to a bound, since
|x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|. Pairs whose upper bound reaches the k-th best
lower bound of their query, or the k-th score found before, survive and are computed from the original vectors; every
other pair is proven not to be among the k nearest. A heap per query merges the tiles.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import stored

K = 20
QUERY_STEP = 20
# A pair of blocks is a row of a few MB, and dozens of rows fit a task's memory.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 2048
# Queries whose dense tile is held at a time.
_STRIP = 256
# Survivors whose original vectors are multiplied at a time.
_PAIRS = 1 << 16

_BLOCK = "dim int, block int, ids binary, vectors binary, tile binary, scales binary, errors binary"


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit tile, scale of each vector, and length of what rounding took."""
    scales = np.abs(vectors).max(axis=1) / 127
    scales[scales == 0] = 1.0  # all components are too small to be divided
    tile = np.rint(vectors / scales[:, None]).astype(np.int8)
    return tile, scales, np.linalg.norm(vectors - tile * scales[:, None], axis=1)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows ``(vec_id, vector)`` laid in blocks of about ``rows``, by hash."""
    sizes = stored(
        vectors.groupBy(F.size("vector").alias("dim")).agg(
            F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks")
        ),
        "block-sizes",
    )
    dealt = vectors.withColumn("dim", F.size("vector")).join(sizes, "dim").withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int")
    )

    def laid(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        matrix = np.stack(frame["vector"].to_numpy()).astype(np.float64)
        tile, scales, errors = _quantised(matrix)
        parts = (frame["vec_id"].to_numpy(np.int64), matrix, tile, scales, errors)
        return pd.DataFrame([(*key, *(part.tobytes() for part in parts))], columns=_names)

    _names = ["dim", "block", "ids", "vectors", "tile", "scales", "errors"]
    return dealt.select("dim", "block", "vec_id", "vector").groupBy("dim", "block").applyInPandas(laid, _BLOCK)


class Block(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    tile: np.ndarray
    scales: np.ndarray
    errors: np.ndarray
    lengths: np.ndarray

    @classmethod
    def read(cls, row: dict, dim: int, prefix: str) -> Block:
        vectors = np.frombuffer(row[f"{prefix}vectors"], np.float64).reshape(-1, dim)
        return cls(
            np.frombuffer(row[f"{prefix}ids"], np.int64),
            vectors,
            np.frombuffer(row[f"{prefix}tile"], np.int8).reshape(-1, dim),
            np.frombuffer(row[f"{prefix}scales"], np.float64),
            np.frombuffer(row[f"{prefix}errors"], np.float64),
            np.linalg.norm(vectors, axis=1),
        )

    def part(self, start: int, count: int) -> Block:
        return Block(*(column[start : start + count] for column in self))


def inner_products(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Row by row, components added in their order, so equal vectors give equal scores."""
    total = np.zeros(len(first))
    for component in range(first.shape[1]):
        total += first[:, component] * second[:, component]
    return total


def survivors(
    queries: Block, candidates: Block, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be among the k nearest of their query: their upper bound reaches the
    k-th lower bound of these blocks and ``floor``, the k-th score found before."""
    dim = queries.tile.shape[1]
    exact = np.float32 if 127 * 127 * dim < 1 << 24 else np.float64  # holds the sums exactly
    product = (queries.tile.astype(exact) @ candidates.tile.astype(exact).T).astype(np.float64)
    product *= queries.scales[:, None]
    product *= candidates.scales[None, :]
    bound = np.outer(queries.errors, candidates.lengths)
    bound += np.outer(queries.lengths + queries.errors, candidates.errors)
    # What floating-point rounding may add.
    bound += 1e-12 * dim * np.outer(queries.lengths, candidates.lengths)
    own = queries.ids[:, None] == candidates.ids[None, :]
    if product.shape[1] > k:
        lower = np.where(own, -np.inf, product - bound)
        floor = np.maximum(floor, np.partition(lower, -k, axis=1)[:, -k])
    return np.nonzero((product + bound >= floor[:, None]) & ~own)


Heap = list[tuple[float, int]]


def _push(heap: Heap, score: float, vec_id: int, k: int) -> None:
    """Keep the k best; of equal scores the smaller ids."""
    if len(heap) < k:
        heapq.heappush(heap, (score, -vec_id))
    else:
        heapq.heappushpop(heap, (score, -vec_id))


def _search_tile(queries: Block, candidates: Block, k: int, heaps: list[Heap]) -> None:
    floor = np.array([heap[0][0] if len(heap) == k else -np.inf for heap in heaps])
    first, second = survivors(queries, candidates, k, floor)
    for begin in range(0, len(first), _PAIRS):
        part = slice(begin, begin + _PAIRS)
        asked, offered = first[part], second[part]
        scores = inner_products(queries.vectors[asked], candidates.vectors[offered])
        rows = zip(asked.tolist(), candidates.ids[offered].tolist(), scores.tolist())
        for place, vec_id, score in rows:
            _push(heaps[place], score, vec_id, k)


def _merged(tiles: DataFrame, k: int) -> DataFrame:
    """The k best of each query, from a heap that holds no more than k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def ranked() -> list[tuple]:
            best = sorted(heap, key=lambda pair: (-pair[0], -pair[1]))
            return [(query, rank, -negative, score) for rank, (score, negative) in enumerate(best, 1)]

        for batch in batches:
            rows = []
            for query_id, vec_id, score in zip(*(column.to_pylist() for column in batch.columns)):
                if query_id != query:
                    rows += ranked()
                    query, heap = query_id, []
                _push(heap, score, vec_id, k)
            yield _rows(rows)
        yield _rows(ranked())

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types)],
            names=["query_id", "rank", "vec_id", "score"],
        )

    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(tasks, "query_id").sortWithinPartitions("query_id")
    return dealt.mapInArrow(run, "query_id bigint, rank int, vec_id bigint, score double")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of each query, exactly.

    Both tables have ``vec_id`` and ``vector``. Vectors that are null, empty, zero or hold a
    null or non-finite component take no part; neither do rows without id. Vectors of
    different lengths are not compared. Repeated rows count once; rows that share an id
    but not the vector are candidates each, and the smallest such vector asks. Of equal
    vectors only the k + 1 smallest ids can be an answer, so the others, which may be a
    third of the table, are set aside before any product. A query has no rows if nothing
    can be compared with it.
    """
    rows = [
        table.select(F.col("vec_id").cast("bigint"), F.col("vector").cast("array<double>"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        for table in (vectors, queries)
    ]
    copies = Window.partitionBy("vector").orderBy("vec_id")
    candidates = (
        rows[0]
        .distinct()
        .withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") <= k + 1)
        .drop("copy")
    )
    asking = rows[1].groupBy("vec_id").agg(F.min("vector").alias("vector"))
    left = stored(_blocks(stored(asking, "queries"), query_block), "query-blocks")
    right = stored(_blocks(stored(candidates, "candidates"), candidate_block), "candidate-blocks")
    names = ["ids", "vectors", "tile", "scales", "errors"]
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A block of queries goes to so many tasks that all are busy, each with a share of the
    # candidates. A task keeps heaps over its whole share, so the rows it hands on grow with
    # the queries and not with the pairs of blocks.
    left_numbers = left.groupBy("dim").agg(
        F.collect_set("block").alias("q_all"),
        F.greatest(F.lit(1), F.ceil(F.lit(tasks) / F.count(F.lit(1)))).cast("int").alias("shares"),
    )
    left_numbers = stored(left_numbers, "query-numbers")
    share = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    asked = left.join(left_numbers, "dim").select(
        "dim", F.col("block").alias("q"), share, *[F.col(n).alias(f"q_{n}") for n in names]
    )
    offered = right.join(left_numbers, "dim").select(
        "dim",
        F.explode("q_all").alias("q"),
        F.pmod("block", "shares").alias("share"),
        *[F.col(n).alias(f"c_{n}") for n in names],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, int], tuple[np.ndarray, list[Heap]]] = {}
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                queries = Block.read(row, row["dim"], "q_")
                candidates = Block.read(row, row["dim"], "c_")
                key = (row["dim"], row["q"])
                if key not in heaps:
                    heaps[key] = (queries.ids, [[] for _ in queries.ids])
                own = heaps[key][1]
                for start in range(0, len(queries.ids), _STRIP):
                    strip = queries.part(start, _STRIP)
                    _search_tile(strip, candidates, k, own[start : start + _STRIP])
        for ids, own in heaps.values():
            found = [(q, -n, s) for q, heap in zip(ids.tolist(), own) for s, n in heap]
            types = [pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 3, types)],
                names=["query_id", "vec_id", "score"],
            )

    tiles = asked.join(offered, ["dim", "q", "share"]).mapInArrow(
        run, "query_id bigint, vec_id bigint, score double"
    )
    return _merged(tiles, k)
