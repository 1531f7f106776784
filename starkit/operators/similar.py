"""Joins of names that are spelled almost alike, by edit distance, without comparing all pairs.

Two names within a distance d share almost all their trigrams: an edit touches at most
three. So with every name's trigrams in one order, rarest first, the first 3 * d + 1 of both
have one in common, and an equality join on those few finds every pair. Two names within d also
share a spelling with at most d characters deleted. Names too short for trigrams are joined on
those, and so are names that meet on a trigram of many: a join on that alone would compare
almost all of them. Every candidate is then verified by its true distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.session import scratch_path

GRAM = 3
# Names of a block that may meet on one trigram. Those of a more frequent one meet on spellings:
# a name then has as many candidates as are near it, however many names there are.
FREQUENT = 64
# Stands before and behind a name; no name holds it.
_EDGE = "\u0001"


def _spellings(names: DataFrame, block: list[str], distance: int) -> DataFrame:
    """``(block..., name, token)`` of all spellings with up to ``distance`` characters deleted, from
    left to right, so that each choice of characters comes once."""
    spelled = names.select(*block, "name", F.col("name").alias("_spelled"), F.lit(1).alias("_at"))
    for _ in range(distance):
        size = F.char_length("_spelled")
        # Place 0 ends the deletions.
        places = F.when(F.col("_at") > size, F.array(F.lit(0))).otherwise(
            F.concat(F.array(F.lit(0)), F.sequence(F.least("_at", size), size))
        )
        cut = F.col("_cut")
        shorter = F.concat(F.substring("_spelled", F.lit(1), cut - 1), F.substring("_spelled", cut + 1, size))
        spelled = spelled.select("*", F.explode(places).alias("_cut")).select(
            *block,
            "name",
            F.when(cut > 0, shorter).otherwise(F.col("_spelled")).alias("_spelled"),
            F.when(cut > 0, cut).otherwise(size + 1).alias("_at"),
        )
    return spelled.select(*block, "name", F.xxhash64(F.lit("s"), "_spelled").alias("token"))


def _grams(names: DataFrame, block: list[str]) -> DataFrame:
    """``(block..., name, gram)``: the trigrams of each name with their number, where one repeats."""
    padded = F.concat(F.lit(_EDGE * (GRAM - 1)), "name", F.lit(_EDGE * (GRAM - 1)))
    plain = F.transform(
        F.sequence(F.lit(1), F.char_length("name") + GRAM - 1), lambda i: F.substring(padded, i, F.lit(GRAM))
    )
    numbered = F.transform(
        "_plain",
        lambda gram, at: F.concat(
            gram, F.size(F.filter(F.slice("_plain", F.lit(1), at), lambda g: g == gram)).cast("string")
        ),
    )
    # A column of its own, so that the trigrams are cut once and not for each of them.
    return names.select(*block, "name", plain.alias("_plain")).select(*block, "name", F.explode(numbered).alias("gram"))


def _tokens(names: DataFrame, frequency: DataFrame, block: list[str], distance: int) -> DataFrame:
    """``(block..., name, token)`` on which names of a block meet, tokens as hashes: those of
    their rarest trigrams that few names have, and spellings of names that are short, may be
    near a short one, or have a frequent one among their rarest."""
    # Grams that two names share at least: the longer one's number of grams - GRAM * distance.
    short_length = GRAM * distance - (GRAM - 1)
    size = F.char_length("name")
    grams = _grams(names.filter(size > short_length), block)
    rare = F.slice(
        F.array_sort(F.collect_list(F.struct("uses", "gram"))), 1, GRAM * distance + 1
    )
    ranked = grams.join(frequency, [*block, "gram"]).groupBy(*block, "name").agg(rare.alias("rarest"))
    # Both names of a pair have the gram that they share, and its number of uses, so both meet
    # on it or both are spelled.
    few = F.filter("rarest", lambda g: g["uses"] <= FREQUENT)
    by_gram = F.transform(few, lambda g: F.xxhash64(F.lit("g"), g["gram"]))
    often = F.exists("rarest", lambda g: g["uses"] > FREQUENT)
    ranked = _stored(ranked.select(*block, "name", by_gram.alias("tokens"), often.alias("often")), "ranked")
    met = ranked.select(*block, "name", F.explode("tokens").alias("token"))
    short = names.filter(size <= short_length).select(*block, "name")
    near = ranked.filter((size <= short_length + distance) | F.col("often")).select(*block, "name")
    return met.union(_spellings(short.union(near), block, distance))


def similar_names(
    left: DataFrame, right: DataFrame, block: list[str], distance: int = 1
) -> DataFrame:
    """Pairs ``(block..., left_name, right_name, distance)`` of all different names of one block
    whose edit distance is at most ``distance``, from ``left(block..., name)`` and ``right``.

    Names are compared as they are. Null names and blocks match nothing; equal names are no
    pair; repeated rows give a pair once.
    """
    if distance < 1:
        raise ValueError("the distance must be 1 or more")
    sides = []
    for df in (left, right):
        names = df.select(*block, "name").na.drop("any").distinct()
        # Both orders must be the same, so all names count, on whichever side.
        sides.append(_stored(names, "names"))
    every = sides[0].union(sides[1]).distinct()
    uses = _grams(every, block).groupBy(*block, "gram").count()
    frequency = _stored(uses.withColumnRenamed("count", "uses"), "gram-uses")
    tokens = [
        _stored(_tokens(names, frequency, block, distance).withColumnRenamed("name", side), f"tokens-{side}")
        for names, side in zip(sides, ("left_name", "right_name"))
    ]
    near = F.abs(F.char_length("left_name") - F.char_length("right_name")) <= distance
    pairs = tokens[0].join(tokens[1], [*block, "token"]).filter(near & (F.col("left_name") != F.col("right_name")))
    # Verified where they meet: only true pairs are shuffled once more.
    found = F.levenshtein("left_name", "right_name", distance)
    verified = pairs.select(*block, "left_name", "right_name", found.alias("distance"))
    return verified.filter(F.col("distance") >= 0).distinct()


def nearest_names(left: DataFrame, right: DataFrame, block: list[str], distance: int = 1) -> DataFrame:
    """``(block..., left_name, right_name, distance, rivals)``: for each left name that the right
    side lacks the nearest right name. Of equally near ones it is the first in order, and
    ``rivals`` is the number of the others."""
    lacking = left.join(right.select(*block, "name").distinct(), [*block, "name"], "left_anti")
    pairs = similar_names(lacking, right, block, distance)
    best = pairs.groupBy(*block, "left_name", "distance").agg(
        F.min("right_name").alias("right_name"), (F.count(F.lit(1)) - 1).alias("rivals")
    )
    first = best.groupBy(*block, "left_name").agg(F.min(F.struct("distance", "right_name", "rivals")).alias("best"))
    return first.select(*block, "left_name", "best.right_name", "best.distance", "best.rivals")


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written and read back: used by several plans, and of known size to joins, which may
    then split a frequent token."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
