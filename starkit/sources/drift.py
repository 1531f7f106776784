"""Feeds whose files do not all have one schema.

The schema of every file is surveyed from its footer. Where the types of a column differ,
they are widened to one that holds all their values; a file whose column has no such type,
or does not fit a given target, is incompatible and named. Files of one schema are read
together and cast, and the groups are united, so a feed costs one scan per schema.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from starkit.operators.checks import CheckFailed
from starkit.session import at_once

# Footers that are read at a time.
SURVEYED_AT_ONCE = 16
_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
# Decimal digits of whole numbers, and bits that a floating type holds exactly.
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


@dataclass(frozen=True)
class FileSchema:
    path: str
    schema: StructType


@dataclass(frozen=True)
class DriftRead:
    """A united feed, its number of schemas, and ``(path, reason)`` of files left out."""

    df: DataFrame
    schemas: int
    incompatible: tuple[tuple[str, str], ...]


def survey(spark: SparkSession, path: str) -> list[FileSchema]:
    """The schema of each parquet file under ``path``, by path. Only footers are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    paths = sorted(row["path"] for row in files.select("path").collect())

    def schema_of(file: str) -> FileSchema:
        return FileSchema(file, spark.read.parquet(file).schema)

    found = []
    for start in range(0, len(paths), SURVEYED_AT_ONCE):
        found += at_once(spark, [partial(schema_of, p) for p in paths[start : start + SURVEYED_AT_ONCE]])
    return found


def widened(one: DataType, other: DataType) -> DataType | None:
    """The narrowest type that holds every value of both exactly; None if there is none."""
    if one == other:
        return one
    if one in _WHOLE and other in _WHOLE:
        return max(one, other, key=_WHOLE.index)
    for a, b in ((one, other), (other, one)):
        if isinstance(b, DoubleType) and (isinstance(a, FloatType) or a in _WHOLE[:3]):
            return b
        if isinstance(b, FloatType) and a in _WHOLE[:2]:
            return b
        if isinstance(b, FloatType) and isinstance(a, IntegerType):
            return DoubleType()
        if isinstance(b, DecimalType) and (isinstance(a, DecimalType) or a in _WHOLE):
            scale_a = a.scale if isinstance(a, DecimalType) else 0
            whole_a = a.precision - a.scale if isinstance(a, DecimalType) else _DIGITS[a]
            scale, whole = max(scale_a, b.scale), max(whole_a, b.precision - b.scale)
            return DecimalType(scale + whole, scale) if scale + whole <= 38 else None
        if isinstance(b, TimestampNTZType) and isinstance(a, DateType):
            return b
    return None


def fits(schema: StructType, target: StructType) -> str | None:
    """Why a file cannot be read as ``target``, or None. Columns are matched in any case; a
    missing one is null, one that the target lacks is left out."""
    wanted = {field.name.lower(): field for field in target}
    names = [field.name.lower() for field in schema]
    if len(set(names)) < len(names):
        return "columns that differ by case alone"
    for field in schema:
        goal = wanted.get(field.name.lower())
        if goal is not None and widened(field.dataType, goal.dataType) != goal.dataType:
            return f"{field.name}: {field.dataType.simpleString()} is no {goal.dataType.simpleString()}"
    return None


def widest_schema(files: list[FileSchema]) -> tuple[StructType, dict[str, str]]:
    """One schema for all files, columns in the order in which they first come, and the reason
    for each file that it leaves out: the first file with a type decides what is compatible."""
    fields: dict[str, StructField] = {}
    left_out: dict[str, str] = {}
    for file in files:
        names = [field.name.lower() for field in file.schema]
        if len(set(names)) < len(names):
            left_out[file.path] = "columns that differ by case alone"
            continue
        grown = dict(fields)
        for field in file.schema:
            known = grown.get(field.name.lower())
            kind = field.dataType if known is None else widened(known.dataType, field.dataType)
            if kind is None:
                shown = known.dataType.simpleString()
                left_out[file.path] = f"{field.name}: {field.dataType.simpleString()} beside {shown}"
                break
            name = field.name if known is None else known.name
            grown[field.name.lower()] = StructField(name, kind)
        else:
            fields = grown
    return StructType(list(fields.values())), left_out


def read_drifting(
    spark: SparkSession, path: str, target: StructType | None = None, skip_incompatible: bool = False
) -> DriftRead:
    """All files under ``path`` as one frame of ``target``, or of their widest schema.

    An incompatible file fails the read, or is left out and named with ``skip_incompatible``.
    A file's column that is wider than the target's does not fit it.
    """
    files = survey(spark, path)
    if not files:
        raise CheckFailed(f"{path}: no files")
    if target is None:
        target, left_out = widest_schema(files)
    else:
        left_out = {f.path: reason for f in files if (reason := fits(f.schema, target))}
    if left_out and not skip_incompatible:
        raise CheckFailed("; ".join(f"{p}: {reason}" for p, reason in sorted(left_out.items())))
    groups: dict[str, list[FileSchema]] = {}
    for file in files:
        if file.path not in left_out:
            groups.setdefault(file.schema.simpleString(), []).append(file)
    parts = [_as_target(spark, group, target) for group in groups.values()]
    if not parts:
        raise CheckFailed(f"{path}: no file fits")
    return DriftRead(reduce(DataFrame.union, parts), len(groups), tuple(sorted(left_out.items())))


def _as_target(spark: SparkSession, group: list[FileSchema], target: StructType) -> DataFrame:
    df = spark.read.schema(group[0].schema).parquet(*[file.path for file in group])
    have = {name.lower(): name for name in df.columns}
    columns = []
    for field in target:
        own = have.get(field.name.lower())
        value = F.lit(None) if own is None else F.col(f"`{own}`")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
