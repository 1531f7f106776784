"""Code maps from label texts.

A label text holds named sections of ``code = 'label'`` lines. A section runs
from the first occurrence of its name to the next semicolon, and the rest of the
line with the name is no entry. Files are parsed in parallel, each one whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions import strip_text


def read_label_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(path, text)`` per label file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def _section_body(text: Column, section: str) -> Column:
    """Text from the section's name to the next semicolon; fails if either is missing."""
    start = F.locate(section, text)
    tail = F.substr(text, start)
    end = F.locate(";", tail)
    return (
        F.when(start == 0, F.raise_error(F.lit(f"label text has no section {section}")))
        .when(end == 0, F.raise_error(F.lit(f"section {section} has no end")))
        .otherwise(F.substr(tail, F.lit(1), end - 1))
    )


def parse_sections(texts: DataFrame, sections: list[str]) -> DataFrame:
    """``(section, code, label)``; the last entry of a code wins.

    Lines without exactly one ``=`` are no entries. Blank codes and labels come
    back as null. Files are ranked by path when a code occurs in several.
    """
    clean = F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), "[\t']", "")
    bodies = F.array(
        *[
            F.struct(F.lit(name).alias("section"), _section_body(F.col("clean"), name).alias("body"))
            for name in sections
        ]
    )
    entry = F.split("line", "=", -1)
    lines = (
        texts.select("path", clean.alias("clean"))
        .select("path", F.inline(bodies))
        .select("path", "section", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
        .where((F.col("pos") > 0) & (F.size(entry) == 2))
    )
    return (
        lines.select(
            "section",
            strip_text(entry[0]).alias("code"),
            strip_text(entry[1]).alias("label"),
            F.struct("path", "pos").alias("place"),
        )
        .groupBy("section", "code")
        .agg(F.max_by("label", "place").alias("label"))
        .select(
            "section",
            F.nullif("code", F.lit("")).alias("code"),
            F.nullif("label", F.lit("")).alias("label"),
        )
    )


def literal_map(
    spark: SparkSession, entries: dict[str, str], code: str, label: str
) -> DataFrame:
    """A code map from fixed entries."""
    rows = [F.struct(F.lit(c).alias(code), F.lit(text).alias(label)) for c, text in entries.items()]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
