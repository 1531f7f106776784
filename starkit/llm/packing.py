"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces are dealt by hash into groups of a few thousand, whatever the size of the table.
Each group is packed by several islands, each with its own population of packings:

* a packing gives each piece a bin; its fitness is the mean of (fill / capacity) squared;
* the first packing is best-fit decreasing, the others best-fit in disturbed orders;
* crossover injects some well-filled bins of one parent whole into the other, removes the
  bins of that parent which hold one of their pieces, and places the displaced pieces by
  best fit, longest first; a mutation dissolves the emptiest bin in the same way;
* between two epochs, an island's elite migrates to the next island of its group; after
  the last one, the best elite of all islands is the packing of the group.

A group stops when it needs no more bins than its tokens fill, which is proof that no
packing is better. Afterwards the badly filled bins of all groups are dissolved and
packed again in at most half as many groups, until one group is left. Pieces too long to
share a bin with any other badly placed one are left where they are. Where so many bins are badly
filled that the groups would not become half as many, only the emptiest bins of each
group and those of the shortest pieces are dissolved. So no group keeps a partial bin of
its own, and the loss does not grow with the number of groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import stored
from starkit.llm.pieces import CAPACITY, cut_documents

GROUP_PIECES = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
CROSSOVERS = 16
INJECTED_BINS = 12
WELL_FILLED = 0.99
# Share of a group's pieces in the emptiest bins that are dissolved if all would be too many.
EMPTIEST = 0.125

# Sequence ids: level of repacking, group, bin.
_BIN_BITS, _GROUP_BITS = 20, 36
# Pieces that fill a sequence alone: their number with the sign-side bit set.
_FULL = 1 << 62


class Packing(NamedTuple):
    """A bin for each piece, and the tokens in each bin."""

    bins: np.ndarray
    fills: np.ndarray

    def fitness(self, capacity: int) -> float:
        """Fewer and more unequal bins are better."""
        return float(((self.fills / capacity) ** 2).mean()) if len(self.fills) else 1.0


def best_fit(
    lengths: np.ndarray,
    order: np.ndarray,
    bins: np.ndarray,
    fills: list[int],
    capacity: int,
) -> Packing:
    """Place the pieces of ``order`` one by one in the fullest bin with room for them."""
    room = sorted((capacity - fill, number) for number, fill in enumerate(fills) if fill < capacity)
    bins = bins.copy()
    for piece in order.tolist():
        length = int(lengths[piece])
        place = bisect_left(room, (length, -1))
        if place < len(room):
            left, number = room.pop(place)
            fills[number] += length
        else:
            left, number = capacity, len(fills)
            fills.append(length)
        bins[piece] = number
        if left > length:
            insort(room, (left - length, number))
    return Packing(bins, np.array(fills, np.int64))


def _repaired(lengths: np.ndarray, bins: np.ndarray, fills: np.ndarray, capacity: int) -> Packing:
    """Renumber the bins in use and place the pieces without one (-1) by best fit."""
    placed = bins >= 0
    used, numbers = np.unique(bins[placed], return_inverse=True)
    bins = bins.copy()
    bins[placed] = numbers
    displaced = np.flatnonzero(~placed)
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return best_fit(lengths, order, bins, fills[used].tolist(), capacity)


def crossover(
    first: Packing, second: Packing, lengths: np.ndarray, capacity: int, random
) -> Packing:
    """Whole well-filled bins of ``second`` injected into ``first``."""
    good = np.flatnonzero(second.fills >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(-second.fills)[:INJECTED_BINS]
    chosen = random.permutation(good)[:INJECTED_BINS]
    injected = np.zeros(len(second.fills), bool)
    injected[chosen] = True
    moved = injected[second.bins]
    broken = np.zeros(len(first.fills), bool)
    broken[first.bins[moved]] = True
    bins = np.where(broken[first.bins], -1, first.bins)
    bins[moved] = len(first.fills) + second.bins[moved]
    return _repaired(lengths, bins, np.concatenate([first.fills, second.fills]), capacity)


def mutation(packing: Packing, lengths: np.ndarray, capacity: int, random) -> Packing:
    """The emptiest bin and a few others dissolved and placed again."""
    count = len(packing.fills)
    dissolved = np.zeros(count, bool)
    dissolved[np.argmin(packing.fills)] = True
    dissolved[random.integers(0, count, min(count, INJECTED_BINS))] = True
    bins = np.where(dissolved[packing.bins], -1, packing.bins)
    return _repaired(lengths, bins, packing.fills, capacity)


def fewest_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing can have fewer bins than this."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def first_population(
    lengths: np.ndarray, capacity: int, size: int, random
) -> list[Packing]:
    """Best-fit decreasing, and best fit in orders that are nearly decreasing."""
    nothing = np.full(len(lengths), -1, np.int64)
    population = []
    for member in range(size):
        noise = 1 + 0.15 * random.standard_normal(len(lengths)) if member else 1.0
        order = np.argsort(-lengths * noise, kind="stable")
        population.append(best_fit(lengths, order, nothing, [], capacity))
        if len(population[0].fills) == fewest_bins(lengths, capacity):
            break
    return population


def evolve(
    population: list[Packing], lengths: np.ndarray, capacity: int, crossovers: int, random
) -> list[Packing]:
    """Steady state: a child replaces the worst member unless it is worse itself.
    The elite comes first in the result."""
    target = fewest_bins(lengths, capacity)
    ranked = sorted(population, key=lambda packing: -packing.fitness(capacity))
    for step in range(crossovers):
        if len(ranked[0].fills) == target or len(ranked) < 2:
            break
        first, second = random.choice(len(ranked), 2, replace=False)
        child = crossover(ranked[first], ranked[second], lengths, capacity, random)
        if step % 4 == 3:
            child = mutation(child, lengths, capacity, random)
        if child.fitness(capacity) >= ranked[-1].fitness(capacity):
            ranked[-1] = child
            ranked.sort(key=lambda packing: -packing.fitness(capacity))
    return ranked


_STATE = (
    "group_id bigint, island int, elite boolean, items binary, lengths binary, "
    "members array<binary>"
)


def _packings(members: list[bytes], lengths: np.ndarray) -> list[Packing]:
    packings = []
    for member in members:
        bins = np.frombuffer(member, np.int32).astype(np.int64)
        packings.append(Packing(bins, np.bincount(bins, lengths).astype(np.int64)))
    return packings


def _members(population: list[Packing]) -> list[bytes]:
    return [packing.bins.astype(np.int32).tobytes() for packing in population]


def _pack_groups(
    items: DataFrame, groups: int, level: int, capacity: int, islands: int, epochs: int
) -> DataFrame:
    """``(item, length, sequence_id, offset, bin_fill)`` of one level."""

    def found(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        group, island = key
        frame = frame.sort_values("item")
        lengths = frame["length"].to_numpy(np.int64)
        random = np.random.default_rng([level, group, island])
        population = first_population(lengths, capacity, POPULATION, random)
        population = evolve(population, lengths, capacity, CROSSOVERS, random)
        state = (frame["item"].to_numpy(np.int64).tobytes(), lengths.tobytes())
        rows = [(group, island, False, *state, _members(population))]
        rows += emigrants(group, island, population, lengths, 0)
        return pd.DataFrame(rows, columns=_columns)

    def emigrants(group: int, island: int, population: list[Packing], lengths: np.ndarray, epoch: int):
        if epoch + 1 >= epochs or len(population[0].fills) == fewest_bins(lengths, capacity):
            return []
        return [(group, (island + 1) % islands, True, b"", b"", _members(population[:1]))]

    def advanced(epoch: int):
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            group, island = key
            own = frame[~frame["elite"]].iloc[0]
            lengths = np.frombuffer(own["lengths"], np.int64)
            random = np.random.default_rng([level, group, island, epoch])
            arrived = [m for members in frame[frame["elite"]]["members"] for m in members]
            population = _packings([*own["members"], *arrived], lengths)
            population.sort(key=lambda packing: -packing.fitness(capacity))
            population = evolve(population[:POPULATION], lengths, capacity, CROSSOVERS, random)
            rows = [(group, island, False, own["items"], own["lengths"], _members(population))]
            rows += emigrants(group, island, population, lengths, epoch)
            return pd.DataFrame(rows, columns=_columns)

        return run

    def settled(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """The best elite of all islands, as rows."""
        own = frame.sort_values("island")
        lengths = np.frombuffer(own["lengths"].iloc[0], np.int64)
        elites = [_packings(list(members[:1]), lengths)[0] for members in own["members"]]
        best = max(elites, key=lambda packing: packing.fitness(capacity))
        order = np.lexsort([-lengths, best.bins])
        sizes, bins = lengths[order], best.bins[order]
        before = np.cumsum(sizes) - sizes
        starts = np.searchsorted(bins, np.arange(len(best.fills)))
        base = (level << (_BIN_BITS + _GROUP_BITS)) | (int(key[0]) << _BIN_BITS)
        return pd.DataFrame(
            {
                "item": np.frombuffer(own["items"].iloc[0], np.int64)[order],
                "length": sizes,
                "sequence_id": base | bins,
                "offset": before - before[starts][bins],
                "bin_fill": best.fills[bins],
            }
        )

    _columns = ["group_id", "island", "elite", "items", "lengths", "members"]
    dealt = items.select(
        "item",
        "length",
        F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)).alias("group_id"),
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
    )
    # A number of its own keeps adaptive execution from gathering this little data, which
    # takes long to work on, in one task.
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "group_id", "island")
    state = stored(dealt.groupBy("group_id", "island").applyInPandas(found, _STATE), "islands")
    for epoch in range(1, epochs):
        # Groups that are proven best send no elite, and only need their islands' best kept.
        pending = state.filter("elite").select("group_id").distinct()
        going = state.join(pending, "group_id", "left_semi").repartition(
            tasks, "group_id", "island"
        )
        ended = state.join(pending, "group_id", "left_anti").filter(~F.col("elite"))
        moved = going.groupBy("group_id", "island").applyInPandas(advanced(epoch), _STATE)
        state = stored(moved.unionByName(ended), "islands")
    return (
        state.filter(~F.col("elite"))
        .groupBy("group_id")
        .applyInPandas(
            settled, "item bigint, length bigint, sequence_id bigint, offset bigint, bin_fill bigint"
        )
    )


def _emptiest(packed: DataFrame) -> DataFrame:
    """``(sequence_id, pieces)`` of the emptiest bin of each group, and of the next ones
    as long as together they hold no more than ``EMPTIEST`` of its pieces; and of as many
    bins of short pieces only, since these fill gaps that another group left."""
    bins = packed.groupBy("sequence_id").agg(
        F.first("bin_fill").alias("fill"),
        F.max("length").alias("longest"),
        F.count(F.lit(1)).alias("pieces"),
    )
    group = Window.partitionBy(F.shiftright("sequence_id", _BIN_BITS))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    emptiest, finest = (group.orderBy(column, "sequence_id") for column in ("fill", "longest"))
    ranked = bins.select(
        "sequence_id",
        "pieces",
        F.row_number().over(emptiest).alias("rank"),
        F.sum("pieces").over(emptiest.rowsBetween(*so_far)).alias("held"),
        F.sum("pieces").over(finest.rowsBetween(*so_far)).alias("held_finest"),
        F.sum("pieces").over(group).alias("all"),
    )
    few = F.least("held", "held_finest") <= EMPTIEST * F.col("all")
    return ranked.filter((F.col("rank") == 1) | few).select("sequence_id", "pieces")


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """``(item, sequence_id, offset)``: every item in one sequence of at most ``capacity``.

    ``items`` has unique numbers ``item`` below 2**61 and a ``length`` from 1 to
    ``capacity``; other columns are not read. No item gives no row. Equal lengths are told
    apart by their number, so the same items give the same packing.
    """
    full = items.filter(F.col("length") == capacity).select(
        "item", (F.col("item") + F.lit(_FULL)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    left = items.filter(F.col("length") < capacity).select("item", "length")
    results, level, count = [full], 0, left.count()
    groups = max(1, -(-count // group_pieces))
    while True:
        packed = stored(
            _pack_groups(left, groups, level, capacity, islands, epochs), f"packed-{level}"
        )
        if groups == 1:
            results.append(packed.select("item", "sequence_id", "offset"))
            break
        again = F.col("bin_fill") < WELL_FILLED * capacity
        # What is longer than the room beside the shortest of these stays alone at any level.
        least = packed.filter(again).agg(F.min("length")).first()[0]
        if least is not None:
            again &= F.col("length") <= capacity - least
        count = packed.filter(again).count()
        if -(-count // group_pieces) > groups // 2:
            bins = stored(_emptiest(packed.filter(again)), f"emptiest-{level}")
            kept = packed.join(bins, "sequence_id", "left_anti")
            left = packed.join(bins, "sequence_id", "left_semi").select("item", "length")
            count = bins.agg(F.sum("pieces")).first()[0]
        else:
            kept = packed.filter(~again)
            left = packed.filter(again).select("item", "length")
        results.append(kept.select("item", "sequence_id", "offset"))
        if not count:
            break
        groups = max(1, min(groups // 2, -(-count // group_pieces)))
        level += 1
    union = results[0]
    for result in results[1:]:
        union = union.union(result)
    return union


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut and pack whole documents: ``(doc_id, piece, start, length, ids_crc32,
    sequence_id, offset)``. See ``cut_documents`` for empty, null and repeated rows."""
    pieces = stored(
        cut_documents(docs, tokenizer_path, capacity).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    return pieces.join(pack(pieces, capacity), "item").drop("item")
