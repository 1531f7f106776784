"""Staging of parquet and delimited sources."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starkit.operators.checks import require_columns, require_not_empty
from starkit.session import at_once


@dataclass(frozen=True)
class SourceSpec:
    """Where a source lies and what it must look like."""

    view: str
    path: str | tuple[str, ...]  # globs, or a list of files
    format: str = "parquet"
    columns: int | None = None  # expected number of columns
    schema: StructType | str | None = None
    separator: str = ","


@dataclass(frozen=True)
class Staged:
    """A staged source with the time its checks took."""

    df: DataFrame
    seconds: float


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read one source; globs are allowed, malformed delimited rows are dropped.

    Delimited rows are parsed in full even when few columns are selected.
    Otherwise a row that the read drops would still be counted, and a file
    without one usable row would pass as not empty.
    """
    reader = spark.read
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    paths = [spec.path] if isinstance(spec.path, str) else list(spec.path)
    if spec.format == "parquet":
        return reader.parquet(*paths)
    if spec.format == "csv":
        return (
            reader.option("header", True)
            .option("sep", spec.separator)
            .option("mode", "DROPMALFORMED")
            .option("columnPruning", False)
            .csv(paths)
        )
    raise ValueError(f"{spec.view}: unknown format {spec.format}")


def stage(spark: SparkSession, specs: list[SourceSpec]) -> dict[str, Staged]:
    """Read and check all sources together, then register each under its view name."""

    def checked(spec: SourceSpec) -> Staged:
        started = time.monotonic()
        df = read_source(spark, spec)
        if spec.columns is not None:
            require_columns(df, spec.view, spec.columns)
        require_not_empty(df, spec.view)
        return Staged(df, time.monotonic() - started)

    staged = at_once(spark, [partial(checked, spec) for spec in specs])
    for spec, source in zip(specs, staged):
        source.df.createOrReplaceTempView(spec.view)
    return {spec.view: source for spec, source in zip(specs, staged)}


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Column names in lower snake case, free of spaces and hyphens."""
    names = [re.sub(r"[^0-9a-z]+", "_", c.strip().lower()).strip("_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalization: {names}")
    return df.toDF(*names)
