"""Delimited sources whose malformed rows are kept beside the good ones.

``read_source`` drops what does not fit the schema. Here a file is parsed once, both kinds
of rows are written, and a source with too many malformed rows fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starkit.operators.checks import CheckFailed
from starkit.session import scratch_path
from starkit.sources.staging import SourceSpec

_RAW, _FILE, _BLOCK, _PLACE, _BAD = "_raw_line", "_file", "_block", "_place", "_malformed"


@dataclass(frozen=True)
class Captured:
    """The rows of a source: ``good`` with its schema, ``bad(file, record, line)``, which counts
    the records of a file from 1 without its header and blank lines."""

    good: DataFrame
    bad: DataFrame
    good_rows: int
    bad_rows: int


def declared_schema(spark: SparkSession, spec: SourceSpec) -> StructType:
    """The schema of a delimited source: as given, or text for every name in its header."""
    if isinstance(spec.schema, StructType):
        return spec.schema
    if spec.schema is not None:
        return StructType.fromDDL(spec.schema)
    paths = [spec.path] if isinstance(spec.path, str) else list(spec.path)
    return spark.read.option("header", True).option("sep", spec.separator).csv(paths).schema


def capture_csv(
    spark: SparkSession, spec: SourceSpec, folder: str | None = None, tolerance: float = 0.1
) -> Captured:
    """Parse a source once and write good and malformed rows to ``folder``, by default in the
    scratch folder; fail if more than ``tolerance`` of its rows are malformed, or all are.

    A row is malformed as for ``read_source``: too few or too many fields, or a field that is not
    of its type. The good rows are exactly those that ``read_source`` keeps.
    """
    schema = declared_schema(spark, spec)
    paths = [spec.path] if isinstance(spec.path, str) else list(spec.path)
    folder = folder or scratch_path(spark, f"captured-{spec.view}")
    parsed = (
        spark.read.schema(StructType([*schema.fields, StructField(_RAW, StringType())]))
        .option("header", True)
        .option("sep", spec.separator)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        .option("columnPruning", False)
        .csv(paths)
        .select(
            "*",
            F.col("_metadata.file_path").alias(_FILE),
            F.col("_metadata.file_block_start").alias(_BLOCK),
            # Rises within a block; stored, so that it is computed once.
            F.monotonically_increasing_id().alias(_PLACE),
            F.col(_RAW).isNotNull().alias(_BAD),
        )
    )
    seen = Observation()
    counted = parsed.observe(
        seen, F.count_if(~F.col(_BAD)).alias("good"), F.count_if(_BAD).alias("bad")
    )
    counted.write.partitionBy(_BAD).parquet(folder)
    good_rows, bad_rows = seen.get["good"], seen.get["bad"]
    if bad_rows > tolerance * (good_rows + bad_rows) or not good_rows:
        raise CheckFailed(f"{spec.view}: {bad_rows} of {good_rows + bad_rows} rows are malformed")
    stored = spark.read.schema(f"{_FILE} string, {_BLOCK} bigint, {_PLACE} bigint, {_RAW} string, {_BAD} boolean")
    good = spark.read.schema(schema).parquet(f"{folder}/{_BAD}=false")
    return Captured(good, _bad_rows(stored.parquet(folder)), good_rows, bad_rows)


def _bad_rows(rows: DataFrame) -> DataFrame:
    """Records are counted by block and summed up over a file's blocks, so that no task numbers
    a whole file; within a block only its malformed rows are looked up."""
    blocks = rows.groupBy(_FILE, _BLOCK).agg(
        F.count(F.lit(1)).alias("_records"), F.min(_PLACE).alias("_first")
    )
    before = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_records").over(before), F.lit(0)))
    bad = rows.filter(F.col(_BAD)).select(_FILE, _BLOCK, _PLACE, _RAW)
    record = F.col("_before") + F.col(_PLACE) - F.col("_first") + 1
    return bad.join(blocks, [_FILE, _BLOCK]).select(
        F.col(_FILE).alias("file"), record.alias("record"), F.col(_RAW).alias("line")
    )
