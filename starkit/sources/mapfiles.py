"""Code maps as delimited files on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starkit.sources.staging import SourceSpec, read_source


def write_code_map(df: DataFrame, path: str, delimiter: str = ";") -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", delimiter)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_code_map(
    spark: SparkSession, path: str, schema: str, delimiter: str = ";"
) -> DataFrame:
    """Read a code map back with the delimiter it was written with."""
    return read_source(
        spark, SourceSpec(path, path, "csv", schema=schema, separator=delimiter)
    )
