"""Published builds over time: their differences, compaction and retention.

None of it disturbs readers. A compaction writes new files beside the old ones and publishes
them as a build of its own; a retention deletes only what no kept entry of the log names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed
from starkit.operators.lookup import REASONS
from starkit.plans import layout
from starkit.plans.builds import COMPACTED, INCREMENTAL, Published, current_build, publish, published
from starkit.plans.cube import CUBE_DIRECTORY, load_cube
from starkit.plans.fact import FEED_ROW
from starkit.plans.sqltables import write_counted

# Differences -------------------------------------------------------------------

# Natural key of each table; ids of one build say nothing about those of another.
NATURAL_KEYS = {
    layout.LOCATION.view: ("port_code", "state_code"),
    layout.DEMOGRAPHICS.view: ("port_code", "city", "state_code", "median_age"),
    layout.COUNTRY.view: ("country_id",),
    layout.DATE.view: ("arrdate",),
    layout.JUNK.view: ("id",),
}
# Columns that differ from build to build by their nature.
GENERATED = {layout.LOCATION.view: ("id",), layout.DEMOGRAPHICS.view: ("id",)}


def row_hash(columns: list[str]) -> list[Column]:
    """128 bits that stand for the values of ``columns``."""
    return [F.xxhash64(*columns).alias("_h1"), F.xxhash64(F.lit(1), *columns).alias("_h2")]


def keyed_diff(before: DataFrame, after: DataFrame, key: tuple[str, ...], ignored: tuple[str, ...] = ()) -> DataFrame:
    """``(key..., change, columns)`` of rows that were added, removed or changed.

    Hashes are compared first, with the key alone beside them; only rows whose hashes differ are
    joined as a whole to name the ``columns`` that changed. Null parts of a key are equal. A
    key must be unique on either side.
    """
    values = [c for c in before.columns if c not in key and c not in ignored]
    if set(before.columns) != set(after.columns):
        raise CheckFailed(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    sides = []
    for df, side in ((before, "old"), (after, "new")):
        hashed = df.select(*key, *row_hash(values or list(key)))
        sides.append(hashed.select(*[F.col(c).alias(f"{side}_{c}") for c in [*key, "_h1", "_h2"]], F.lit(1).alias(side)))
    same_key = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in key])
    differ = (F.col("old__h1") != F.col("new__h1")) | (F.col("old__h2") != F.col("new__h2"))
    found = sides[0].join(sides[1], same_key, "full_outer").filter(
        F.col("old").isNull() | F.col("new").isNull() | differ
    )
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    keys = [F.when(F.col("new").isNull(), F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in key]
    found = found.select(*keys, change.alias("change"))
    if not values:
        return found.withColumn("columns", F.array().cast("array<string>"))
    changed = found.filter("change = 'changed'").select(*key)
    both = changed
    for df, side in ((before, "old"), (after, "new")):
        renamed = df.select(*[F.col(c).alias(f"{side}_{c}") for c in [*key, *values]])
        match = [F.col(c).eqNullSafe(F.col(f"{side}_{c}")) for c in key]
        both = both.join(renamed, reduce(lambda a, b: a & b, match))
    names = [F.when(~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")), c) for c in values]
    named = both.select(*key, F.lit("changed").alias("change"), F.array_compact(F.array(*names)).alias("columns"))
    others = found.filter("change != 'changed'").withColumn("columns", F.array().cast("array<string>"))
    return others.unionByName(named)


def bag_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(columns..., surplus)`` of rows without a key: how many more of them ``after`` has. Equal
    rows are counted on the map side by hash; only hashes with a surplus are looked up."""
    columns = before.columns
    counts = [
        df.select(*row_hash(columns), F.lit(sign).alias("_n")).groupBy("_h1", "_h2").agg(F.sum("_n").alias("_n"))
        for df, sign in ((before, -1), (after.select(*columns), 1))
    ]
    surplus = counts[0].union(counts[1]).groupBy("_h1", "_h2").agg(F.sum("_n").alias("surplus")).filter("surplus != 0")
    parts = [df.select(*columns, *row_hash(columns)) for df in (before, after.select(*columns))]
    rows = [part.join(surplus, ["_h1", "_h2"]).drop("_h1", "_h2").distinct() for part in parts]
    return rows[0].union(rows[1]).distinct()


def _table(spark: SparkSession, target: str, entry: Published, spec: layout.TableSpec) -> DataFrame:
    paths = [f"{target}/{entry.build}/{spec.directory}"]
    if spec == layout.FACT:
        paths = [f"{target}/{part}" for part in entry.fact_parts]
    return spark.read.schema(spec.ddl).parquet(*paths)


def build_diff(spark: SparkSession, target: str, old: int, new: int) -> DataFrame:
    """``(table_name, row_key, change, columns)`` of the dimensions of two published builds, by their
    numbers. ``row_key`` is the natural key as text."""
    entries = {entry.number: entry for entry in published(spark, target)}
    if missing := {old, new} - set(entries):
        raise CheckFailed(f"{target}: no build {sorted(missing)}")
    parts = []
    for spec in layout.TABLES:
        if spec == layout.FACT:
            continue
        key = NATURAL_KEYS[spec.view]
        sides = [_table(spark, target, entries[number], spec) for number in (old, new)]
        found = keyed_diff(*sides, key, GENERATED.get(spec.view, ()))
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
        parts.append(found.select(F.lit(spec.view).alias("table_name"), text.alias("row_key"), "change", "columns"))
    return reduce(DataFrame.union, parts)


def fact_diff(spark: SparkSession, target: str, old: int, new: int) -> DataFrame:
    """Fact rows that one of two published builds has more of, without generated ids: places and
    cities are named by their natural keys."""
    entries = {entry.number: entry for entry in published(spark, target)}
    if missing := {old, new} - set(entries):
        raise CheckFailed(f"{target}: no build {sorted(missing)}")
    sides = []
    for number in (old, new):
        fact = _table(spark, target, entries[number], layout.FACT)
        for spec, foreign in ((layout.LOCATION, "arrival_location_id"), (layout.DEMOGRAPHICS, "arrlocation_demographics_id")):
            names = _table(spark, target, entries[number], spec)
            key = [F.col(c).alias(f"{foreign.removesuffix('_id')}_{c}") for c in NATURAL_KEYS[spec.view]]
            fact = fact.join(names.select(F.col("id").alias(foreign), *key), foreign)
        sides.append(fact.drop("id", "arrival_location_id", "arrlocation_demographics_id"))
    return bag_diff(*sides)


# Compaction --------------------------------------------------------------------


def compact(spark: SparkSession, target: str, file_rows: int = 5_000_000) -> Published:
    """Rewrite the parts of the current fact, and of the kept lost rows, as one each, in files of
    about ``file_rows`` rows, and publish the result. Ids stay. Nothing happens if there is one
    part already. The old parts stay for readers that have begun; ``retain`` deletes them."""
    current = current_build(spark, target)
    if len(current.fact_parts) < 2 and len(current.reject_parts) < 2:
        return current
    folder = f"compact-{uuid.uuid4().hex}"
    fact = spark.read.schema(layout.FACT.ddl).parquet(*[f"{target}/{p}" for p in current.fact_parts])
    rows = fact.count()
    files = max(1, -(-rows // file_rows))
    fact_part = f"{folder}/{layout.FACT.directory}"
    # Dealt by id: ids are spread evenly, whatever values the rows share.
    written = write_counted(fact.repartition(files, "id"), f"{target}/{fact_part}")
    if written != rows:
        raise CheckFailed(f"{target}: {written} of {rows} rows were rewritten")
    reject_parts = current.reject_parts
    if len(reject_parts) > 1:
        lost = spark.read.parquet(*[f"{target}/{part}" for part in reject_parts])
        reject_parts = (f"{folder}/rejects.parquet",)
        count = lost.count()
        lost = lost.select(FEED_ROW, REASONS).repartition(max(1, -(-count // file_rows)))
        write_counted(lost, f"{target}/{reject_parts[0]}")
    if _has_cubes(spark, target, current):
        cube = load_cube(spark, target)
        keys = [c for c in cube.columns if c != "visits"]
        cube = cube.groupBy(*keys).agg(F.sum("visits").alias("visits"))
        write_counted(cube, f"{target}/{folder}/{CUBE_DIRECTORY}", ("grouping_set",))
    publish(spark, target, current.build, COMPACTED, (fact_part,), reject_parts)
    return current_build(spark, target)


def _has_cubes(spark: SparkSession, target: str, entry: Published) -> bool:
    folders = {part.split("/")[0] for part in entry.fact_parts}
    return all(_exists(spark, f"{target}/{folder}/{CUBE_DIRECTORY}") for folder in folders)


# Retention ---------------------------------------------------------------------


@dataclass(frozen=True)
class Retained:
    """Entries that were kept, and folders that were deleted."""

    kept: tuple[Published, ...]
    deleted: tuple[str, ...]


def _path(spark: SparkSession, path: str):
    """A path and its file system; any store that Spark can write to."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    found, files = _path(spark, path)
    return files.exists(found)


def named_folders(entries: list[Published]) -> set[str]:
    """The folders under the target that some entries need."""
    needed = set()
    for entry in entries:
        needed.add(entry.build)
        needed.update(part.split("/")[0] for part in (*entry.fact_parts, *entry.reject_parts))
    return needed


def retain(spark: SparkSession, target: str, keep: int = 7, grace_seconds: int = 86_400) -> Retained:
    """Delete the folders of builds that none of the last ``keep`` entries needs.

    The latest entry of every kind is kept in any case, since the next build may add to it; a
    compaction stands for the daily build that it rewrote. A folder
    whose files are younger than ``grace_seconds`` stays: a build may be writing it, or a reader
    may have begun with an older entry. The log stays whole; an older entry whose folders are
    gone can no longer be read, and is never the current one. Interrupted anywhere, a later call
    does the rest.
    """
    if keep < 1:
        raise ValueError("at least one build is kept")
    entries = published(spark, target)
    if not entries:
        raise CheckFailed(f"{target}: no build was published")
    kept = entries[:keep]
    families = {entry.kind: entry.kind for entry in entries} | {COMPACTED: INCREMENTAL}
    for family in set(families.values()):
        latest = next((entry for entry in entries if families[entry.kind] == family), None)
        if latest is not None and latest not in kept:
            kept.append(latest)
    needed = named_folders(kept) | {layout.PUBLISHED}
    root, files = _path(spark, target)
    now = spark._jvm.System.currentTimeMillis()
    deleted = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        ours = name.startswith((layout.BUILD_PREFIX, "compact-"))
        if ours and name not in needed and now - _last_change(files, status) >= 1000 * grace_seconds:
            files.delete(status.getPath(), True)
            deleted.append(name)
    return Retained(tuple(kept), tuple(sorted(deleted)))


def _last_change(files, status) -> int:
    """The latest modification of a folder or of what lies two levels below."""
    latest = status.getModificationTime()
    for table in files.listStatus(status.getPath()):
        latest = max(latest, table.getModificationTime())
        if table.isDirectory():
            for part in files.listStatus(table.getPath()):
                latest = max(latest, part.getModificationTime())
    return latest
