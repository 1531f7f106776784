"""Daily builds: only new feed files are read, and no id that was given ever changes.

A build adds to the one before it:

* The list of feed files says which are new. A file that changed since it was read fails the
  build; a file that is gone is taken as archived.
* Dimensions are the members known so far and those of the new files. A registry of keys keeps
  the id of every member that a build has ever had; new members are numbered behind them.
* The fact gets a new part. It holds the rows of the new files, earlier lost rows that the
  grown dimensions now know, and the rows by which new cities repeat earlier fact rows of
  their port. Together with the parts before, this is the fact of a build from all files.
* Lost rows are kept. They are rewritten only by a build whose dimensions have grown.

Where the label texts, the city statistics or an option that shapes rows differ from those of
the last build, members may disappear, and adding is not enough: all files are read again,
but ids still come from the registry.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed
from starkit.operators.keys import dense_key
from starkit.operators.lookup import REASONS
from starkit.plans import layout
from starkit.plans.builds import COMPACTED, INCREMENTAL, Published, current_build, publish, published
from starkit.plans.cube import write_cube
from starkit.plans.dimensions import (
    LOCATION_KEY,
    date_dimension,
    demographics_members,
    junk_dimension,
    location_members,
    observed_places,
)
from starkit.plans.fact import FEED_ROW, Dimensions
from starkit.plans.metrics import TableMetrics
from starkit.plans.model import (
    BuildConfig,
    Sources,
    country_builder,
    load_model,
    lookup_dimensions,
    stage_sources,
    stored_dimensions,
    write_dimensions,
)
from starkit.plans.quarantine import SplitCounts, read_rejects, split_feed, write_split
from starkit.session import scratch_path

_FILES, _STATE = "feed_files.parquet", "state.parquet"
_FILES_SCHEMA = "path string, length bigint, modified timestamp"
_STATE_SCHEMA = "sources string, next_id bigint"


def _registry(spec: layout.TableSpec) -> str:
    return f"keys_{spec.directory}"


@dataclass(frozen=True)
class Earlier:
    """What a build finds of the one that it adds to."""

    entry: Published
    files: DataFrame
    sources: str
    next_id: int


def feed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, modified)`` of the files of a feed; their contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _earlier(spark: SparkSession, target: str) -> Earlier | None:
    entries = published(spark, target, INCREMENTAL, COMPACTED)
    if not entries:
        return None
    folder = f"{target}/{entries[0].build}"
    state = spark.read.schema(_STATE_SCHEMA).parquet(f"{folder}/{_STATE}").first()
    files = spark.read.schema(_FILES_SCHEMA).parquet(f"{folder}/{_FILES}")
    return Earlier(entries[0], files, state["sources"], state["next_id"])


def new_files(files: DataFrame, known: DataFrame) -> list[str]:
    """Paths that ``known`` lacks; a known path whose file changed fails."""
    both = files.join(known.select("path", *[F.col(c).alias(f"known_{c}") for c in ("length", "modified")]), "path", "left")
    differs = (F.col("known_length") != F.col("length")) | (F.col("known_modified") != F.col("modified"))
    changed = both.filter(differs).orderBy("path").head(1)
    if changed:
        raise CheckFailed(f"{changed[0]['path']}: changed since it was read")
    return sorted(row["path"] for row in both.filter(F.col("known_length").isNull()).collect())


def sources_digest(sources: Sources, config: BuildConfig) -> str:
    """Equal for equal label texts, city statistics and options that shape rows."""
    maps = sources.maps
    tables = [maps.port, maps.country, maps.country_members, maps.transport, sources.demographics]
    parts = [config.unknown_countries, str(config.city_distance)]
    for table in tables:
        hashed = F.xxhash64(*table.columns)
        row = table.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(hashed), F.lit(0))).first()
        parts += [f"{row[0]}:{row[1]}"]
    return ",".join(parts)


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    pairs = [left[c].eqNullSafe(right[c]) for c in columns]
    return reduce(lambda a, b: a & b, pairs)


def registered(members: DataFrame, registry: DataFrame | None, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """``members`` with their ids, and the grown registry ``(id, key...)``.

    A member that the registry has keeps its id; the others are numbered in the order of
    ``key`` from the first id behind all that were ever given. Null parts of a key are equal.
    """
    if registry is None:
        numbered = dense_key(members, key)
        return numbered, numbered.select("id", *key)
    known = registry.select("id", *key)
    found = members.join(known, _same(members, known, key)).select(known["id"], *[members[c] for c in members.columns])
    new = members.join(known, _same(members, known, key), "left_anti")
    last = registry.agg(F.max("id")).first()[0] or 0
    added = dense_key(new, key).withColumn("id", F.col("id") + last)
    return found.unionByName(added), known.unionByName(added.select("id", *key))


def _grown(new: DataFrame, table: DataFrame | None) -> DataFrame:
    """Members of the new files and of the build before."""
    return new if table is None else new.unionByName(table.select(*new.columns)).distinct()


def _repeats_for_new_cities(
    facts: DataFrame, before: DataFrame, after: DataFrame, last: int
) -> DataFrame:
    """Earlier fact rows once more for each city that their port has got since.

    ``before`` and ``after`` are the demographics; ids above ``last`` are new. A feed row has one
    fact row for each city of its port, so those of the port's first city stand for all.
    """
    first = before.groupBy("port_code").agg(F.min("id").alias("_first_city"))
    new = after.filter(F.col("id") > last).select("port_code", F.col("id").alias("_new_city"))
    pairs = first.join(new, "port_code").select("_first_city", "_new_city")
    rows = facts.join(pairs, facts["arrlocation_demographics_id"] == pairs["_first_city"])
    rows = rows.withColumn("arrlocation_demographics_id", F.col("_new_city"))
    return rows.select(*[c for c in layout.FACT.columns if c != "id"])


def _dimensions(
    spark: SparkSession, sources: Sources, config: BuildConfig, earlier: Earlier | None, adding: bool, folder: str
) -> tuple[dict[str, DataFrame], list[TableMetrics], int]:
    """The written dimensions, and the largest demographics id given before."""
    feed, maps = sources.feed, sources.maps
    places = observed_places(feed).checkpoint()
    old_folder = f"{config.target}/{earlier.entry.build}" if earlier else None

    def old(name: str, spec: layout.TableSpec, columns: list[str]) -> DataFrame | None:
        if old_folder is None:
            return None
        ddl = ", ".join(f"{c} {spec.schema[c]}" for c in columns)
        return spark.read.schema(ddl).parquet(f"{old_folder}/{name}")

    def keyed(spec: layout.TableSpec, key: list[str], members: Callable[[], DataFrame]) -> DataFrame:
        table = old(spec.directory, spec, spec.columns) if adding else None
        registry = old(_registry(spec), spec, ["id", *key])
        numbered, grown = registered(_grown(members(), table), registry, key)
        grown.write.parquet(f"{folder}/{_registry(spec)}")
        return numbered

    def natural(spec: layout.TableSpec, members: Callable[[], DataFrame]) -> DataFrame:
        table = old(spec.directory, spec, spec.columns) if adding else None
        return _grown(members().select(*spec.columns), table)

    cities_key = [c for c in layout.DEMOGRAPHICS.columns if c != "id"]
    cities = partial(
        demographics_members, places, maps.port, sources.demographics, config.city_distance
    )
    builds = {
        layout.LOCATION.view: partial(
            keyed, layout.LOCATION, LOCATION_KEY, partial(location_members, places, maps.port)
        ),
        layout.DEMOGRAPHICS.view: partial(keyed, layout.DEMOGRAPHICS, cities_key, cities),
        layout.COUNTRY.view: partial(natural, layout.COUNTRY, country_builder(feed, maps, config)),
        layout.DATE.view: partial(natural, layout.DATE, partial(date_dimension, feed)),
        layout.JUNK.view: partial(junk_dimension, maps.transport, layout.VISA_TYPES),
    }
    registry = old(_registry(layout.DEMOGRAPHICS), layout.DEMOGRAPHICS, ["id"])
    last = (registry.agg(F.max("id")).first()[0] or 0) if registry is not None else 0
    return *write_dimensions(spark, builds, folder), last


def _have_grown(before: Dimensions, after: Dimensions) -> bool:
    """Whether a lookup knows more than it did; dimensions that are added to never shrink."""
    pairs = [(before.location, after.location), (before.demographics, after.demographics)]
    pairs += [(before.country, after.country)]
    return any(old.count() < new.count() for old, new in pairs)


def incremental_build(
    spark: SparkSession, config: BuildConfig
) -> tuple[dict[str, DataFrame], list[TableMetrics]]:
    """Add the feed files that are new since the last build of this kind to the model.

    The first build reads all files. Without a new file, and with the sources as they were,
    the model stays as it is and there are no metrics. A build that fails leaves the model as
    it was. Ids of the fact count on from build to build, so keys of ``fact_keys`` "stable" and
    a partitioned fact are not offered here.
    """
    if config.fact_keys != "positional" or config.partition_fact:
        raise ValueError("an incremental build has positional keys and no partitions")
    earlier = _earlier(spark, config.target)
    files = feed_files(spark, config.feed_path)
    # Listed once and stored: a file that arrives meanwhile is the next build's.
    listed = scratch_path(spark, "feed-files")
    files.write.parquet(listed)
    files = spark.read.schema(_FILES_SCHEMA).parquet(listed)
    everything = sorted(row["path"] for row in files.select("path").collect())
    added = new_files(files, earlier.files) if earlier else everything
    if not everything:
        raise CheckFailed(f"{config.feed_path}: no files")

    sources, metrics = stage_sources(spark, replace(config, feed_path=tuple(added or everything)))
    digest = sources_digest(sources, config)
    adding = earlier is not None and earlier.sources == digest
    if adding and not added:
        return load_model(spark, config.target), []
    if earlier and not adding and len(added) < len(everything):
        sources, metrics = stage_sources(spark, replace(config, feed_path=tuple(everything)))

    build = f"{layout.BUILD_PREFIX}{uuid.uuid4().hex}"
    folder = f"{config.target}/{build}"
    tables, measured, last_city = _dimensions(spark, sources, config, earlier, adding, folder)
    metrics += measured
    dims = lookup_dimensions(spark, tables, sources.maps, config)
    started = time.monotonic()
    counts, fact_parts, reject_parts = _write_parts(
        spark, sources.feed, dims, config, earlier, adding, last_city, folder, build
    )
    if not fact_parts:
        raise CheckFailed(f"{layout.FACT.view}: no rows")
    seconds = time.monotonic() - started
    metrics.append(TableMetrics(layout.FACT.view, counts.fact_rows, seconds))
    metrics.append(TableMetrics("rejected", counts.rejected_rows, seconds))
    (files if earlier is None else _all_files(files, earlier.files)).write.parquet(f"{folder}/{_FILES}")
    state = spark.createDataFrame([(digest, counts.next_id)], _STATE_SCHEMA)
    state.coalesce(1).write.parquet(f"{folder}/{_STATE}")
    publish(spark, config.target, build, INCREMENTAL, fact_parts, reject_parts)
    return load_model(spark, config.target), metrics


def _all_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files that were read, archived ones included."""
    return files.union(known.join(files, "path", "left_anti"))


def _write_parts(
    spark: SparkSession,
    feed: DataFrame,
    dims: Dimensions,
    config: BuildConfig,
    earlier: Earlier | None,
    adding: bool,
    last_city: int,
    folder: str,
    build: str,
) -> tuple[SplitCounts, tuple[str, ...], tuple[str, ...]]:
    """Write this build's part of the fact and of the lost rows; all parts of the model."""
    fact_parts, reject_parts = (), ()
    rows = feed.select(*layout.USED_COLUMNS)
    repeats = None
    if adding:
        fact_parts, reject_parts = earlier.entry.fact_parts, earlier.entry.reject_parts
        before = stored_dimensions(_tables_of(spark, config.target, earlier.entry))
        if _have_grown(before, dims):
            paths = [f"{config.target}/{part}" for part in reject_parts]
            if paths:
                rows = rows.unionByName(read_rejects(spark, paths, rows).drop(REASONS))
            reject_parts = ()  # what is lost still is written with this build's
            facts = spark.read.schema(layout.FACT.ddl).parquet(*[f"{config.target}/{p}" for p in fact_parts])
            repeats = _repeats_for_new_cities(facts, before.demographics, dims.demographics, last_city)
    split = split_feed(rows, dims)
    if repeats is not None:
        empty = F.lit(None).cast(split.schema[FEED_ROW].dataType).alias(FEED_ROW)
        split = split.unionByName(repeats.select("*", F.lit(0).alias(REASONS), empty))
    counts = write_split(split, folder, earlier.next_id if earlier else 0)
    if counts.fact_rows:
        fact_parts = (*fact_parts, f"{build}/{layout.FACT_PART}")
        if config.cube:
            write_cube(spark.read.schema(layout.FACT.ddl).parquet(f"{folder}/{layout.FACT_PART}"), folder)
    if counts.rejected_rows:
        reject_parts = (*reject_parts, f"{build}/{layout.REJECT_PART}")
    return counts, fact_parts, reject_parts


def _tables_of(spark: SparkSession, target: str, entry: Published) -> dict[str, DataFrame]:
    """The dimensions of a build."""
    return {
        spec.view: spark.read.schema(spec.ddl).parquet(f"{target}/{entry.build}/{spec.directory}")
        for spec in layout.TABLES
        if spec != layout.FACT
    }


def lost_rows(spark: SparkSession, target: str, feed: DataFrame) -> DataFrame:
    """The model's lost feed rows ``(columns..., reject_reasons)``, with the columns of ``feed``
    that the fact uses."""
    parts = current_build(spark, target).reject_parts
    used = feed.select(*layout.USED_COLUMNS)
    return read_rejects(spark, [f"{target}/{part}" for part in parts], used)
