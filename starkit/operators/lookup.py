"""Star lookups: a feed joined to its dimensions.

No broadcast hints. Dimensions are read back from parquet, so their size is
known, and Spark broadcasts those below ``spark.sql.autoBroadcastJoinThreshold``.
A larger one is sort-merge joined, with hot keys split by adaptive execution.
It splits a join only where both sides are dealt anew. A lookup by a key that an
earlier one has used is therefore matched null-safe, on keys without nulls: the rows
are the same, but the earlier partitioning is not reused.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed
from starkit.operators.guards import duplicate_keys

# The column of ``split_lookup``.
REASONS = "reject_reasons"


@dataclass(frozen=True)
class Lookup:
    """How the feed finds a dimension row and what it takes from it."""

    name: str
    table: DataFrame
    on: dict[str, Column]  # dimension key -> expression on the feed
    take: dict[str, str]  # dimension column -> output column
    allow_fanout: bool = False  # accept several dimension rows per feed row


def _key(lookup: Lookup, key: str) -> str:
    return f"_{lookup.name}_{key}"


def _match(lookup: Lookup, null_safe: bool = False) -> Column:
    pairs = [(expression, F.col(_key(lookup, key))) for key, expression in lookup.on.items()]
    matches = [left.eqNullSafe(right) if null_safe else left == right for left, right in pairs]
    return reduce(lambda left, right: left & right, matches)


def _repeats(lookups: list[Lookup]) -> list[bool]:
    """Whether an earlier lookup goes by one of the same expressions on the feed."""
    used: set[str] = set()
    repeats = []
    for lookup in lookups:
        own = {str(expression) for expression in lookup.on.values()}
        repeats.append(not own.isdisjoint(used))
        used |= own
    return repeats


def _require_single_matches(lookups: list[Lookup]) -> None:
    """Fail, in one job, if any lookup could multiply rows without leave."""
    checked = set()  # a table may serve several roles
    repeated = []
    for lookup in lookups:
        keys = list(lookup.on)
        if lookup.allow_fanout or (id(lookup.table), *keys) in checked:
            continue
        checked.add((id(lookup.table), *keys))
        matchable = lookup.table.na.drop("any", subset=keys)
        repeated.append(duplicate_keys(matchable, keys).select(F.lit(lookup.name)))
    found = reduce(DataFrame.union, repeated).head(1) if repeated else []
    if found:
        raise CheckFailed(f"{found[0][0]}: lookup key is not unique")


def star_lookup(feed: DataFrame, lookups: list[Lookup], verify: bool = True) -> DataFrame:
    """Inner join ``feed`` with every lookup; rows that miss one are dropped.

    The result holds the feed's columns followed by the taken ones. ``verify``
    first checks that no lookup multiplies rows, unless it is allowed to.
    """
    if verify:
        _require_single_matches(lookups)
    result = feed
    for lookup, again in zip(lookups, _repeats(lookups)):
        table = lookup.table.na.drop("any", subset=list(lookup.on)) if again else lookup.table
        dimension = table.select(
            *[F.col(key).alias(_key(lookup, key)) for key in lookup.on],
            *[F.col(column).alias(output) for column, output in lookup.take.items()],
        )
        result = result.join(dimension, _match(lookup, null_safe=again)).drop(
            *[_key(lookup, key) for key in lookup.on]
        )
    return result


def split_lookup(feed: DataFrame, lookups: list[Lookup], verify: bool = True) -> DataFrame:
    """Every feed row with what the lookups take, and ``reject_reasons``, in one pass.

    Bit i of the reasons is set where lookup i has no match; the taken columns of that lookup
    are null. Rows without a reason are those of ``star_lookup``, as often as there: a
    lookup that may fan out repeats them. A row with a reason comes once.
    """
    if verify:
        _require_single_matches(lookups)
    marked, hits = feed, []
    for lookup, again in zip(lookups, _repeats(lookups)):
        hits.append(f"_hit_{lookup.name}")
        keys = [F.col(key).alias(_key(lookup, key)) for key in lookup.on]
        if lookup.allow_fanout:
            # Which rows to repeat is known only after all lookups.
            table = lookup.table.select(*keys).distinct()
        else:
            taken = [F.col(column).alias(output) for column, output in lookup.take.items()]
            table = lookup.table.select(*keys, *taken)
        # Null-safe for the reasons given in ``reject_report``.
        null_safe = again or lookup.allow_fanout
        table = table.na.drop("any", subset=[_key(lookup, key) for key in lookup.on])
        marked = marked.join(
            table.withColumn(hits[-1], F.lit(True)), _match(lookup, null_safe), "left"
        ).drop(*[_key(lookup, key) for key in lookup.on])
    bits = [F.when(F.col(hit).isNull(), 1 << number).otherwise(0) for number, hit in enumerate(hits)]
    result = marked.withColumn(REASONS, reduce(lambda left, right: left + right, bits)).drop(*hits)
    for lookup in lookups:
        if lookup.allow_fanout:
            table = lookup.table.na.drop("any", subset=list(lookup.on)).select(
                *[F.col(key).alias(_key(lookup, key)) for key in lookup.on],
                *[F.col(column).alias(output) for column, output in lookup.take.items()],
            )
            kept = (F.col(REASONS) == 0) & _match(lookup, null_safe=True)
            result = result.join(table, kept, "left").drop(*[_key(lookup, key) for key in lookup.on])
    return result


def reason_names(lookups: list[Lookup], reasons: Column) -> Column:
    """The names of the lookups whose bits are set."""
    names = [F.when(reasons.bitwiseAND(1 << k) != 0, lookup.name) for k, lookup in enumerate(lookups)]
    return F.array_compact(F.array(*names))


def reject_report(feed: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Feed rows that miss each lookup, and rows that miss any, in one scan.

    Rows ``(lookup_name, feed_rows, rejected_rows)``; the last is named ``any``.
    """
    _require_single_matches(lookups)
    marked = feed
    for lookup, again in zip(lookups, _repeats(lookups)):
        names = [_key(lookup, key) for key in lookup.on]
        keys = lookup.table.select(*[F.col(k).alias(n) for k, n in zip(lookup.on, names)])
        if lookup.allow_fanout:
            # For the same reason as a repeated key: ``distinct`` partitions by the key.
            keys = keys.distinct()
        null_safe = again or lookup.allow_fanout
        if null_safe:
            keys = keys.na.drop("any")
        marked = marked.join(
            keys.withColumn(f"_hit_{lookup.name}", F.lit(True)),
            _match(lookup, null_safe=null_safe),
            "left",
        )
    misses = {lookup.name: F.col(f"_hit_{lookup.name}").isNull() for lookup in lookups}
    misses["any"] = reduce(lambda left, right: left | right, list(misses.values()))
    totals = marked.agg(
        F.count(F.lit(1)).alias("feed_rows"),
        *[F.count_if(missed).alias(name) for name, missed in misses.items()],
    )
    pairs = [
        F.struct(F.lit(name).alias("lookup_name"), F.col(name).alias("rejected_rows"))
        for name in misses
    ]
    return totals.select("feed_rows", F.inline(F.array(*pairs))).select(
        "lookup_name", "feed_rows", "rejected_rows"
    )
