"""The set of code maps behind the dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions import (
    UNKNOWN_CODE,
    UNKNOWN_LABEL,
    is_unknown_label,
    place_name,
    place_state,
)
from starkit.operators.checks import require_columns, require_not_empty
from starkit.operators.guards import unique_guard
from starkit.plans import layout
from starkit.sources.labels import literal_map, parse_sections
from starkit.sources.mapfiles import write_code_map


@dataclass(frozen=True)
class CodeMaps:
    """Cleaned code maps; ``country_members`` keeps the codes behind the unknown member."""

    country: DataFrame  # country_id, country_name
    country_members: DataFrame  # country_code, country_id, country_name
    state: DataFrame
    transport: DataFrame
    port: DataFrame
    visa: DataFrame
    # The maps as they are exported, before countries are put together.
    exported: dict[layout.MapSpec, DataFrame]


def country_members(codes: DataFrame) -> DataFrame:
    """Each country code with its member: itself, or the common unknown one."""
    label = F.col("country_name")
    unknown = is_unknown_label(label) | (label == UNKNOWN_LABEL)
    code = F.col("country_code").try_cast("int")
    return codes.select(
        code.alias("country_code"),
        F.when(unknown, F.lit(UNKNOWN_CODE)).otherwise(code).alias("country_id"),
        F.when(unknown, F.lit(UNKNOWN_LABEL)).otherwise(label).alias("country_name"),
    )


def cluster_unknown(codes: DataFrame) -> DataFrame:
    """The country map with all unknown labels under one member."""
    return country_members(codes).select("country_id", "country_name").distinct()


def split_places(codes: DataFrame) -> DataFrame:
    """The port map from ``NAME, STATE`` labels; other labels are dropped."""
    return codes.select(
        "port_code",
        F.nullif(place_name(F.col("label")), F.lit("")).alias("port_name"),
        F.nullif(place_state(F.col("label")), F.lit("")).alias("port_state"),
    ).na.drop("any")


def _checked(df: DataFrame, spec: layout.MapSpec) -> DataFrame:
    require_not_empty(df, spec.view)
    require_columns(df, spec.view, list(spec.columns))
    return df.na.drop("any")


def export_code_maps(maps: CodeMaps, folder: str, delimiter: str = ";") -> None:
    """Write all maps as delimited files."""
    for spec, df in maps.exported.items():
        write_code_map(df, f"{folder}/{spec.file}", delimiter)


def build_code_maps(spark: SparkSession, texts: DataFrame) -> CodeMaps:
    """Parse, check and register the maps."""
    sections = [
        layout.COUNTRY_SECTION,
        layout.PORT_SECTION,
        layout.TRANSPORT_SECTION,
        layout.STATE_SECTION,
    ]
    # Every map reads the parsed entries, so the label files are parsed once.
    entries = parse_sections(texts, sections).checkpoint()

    def section(name: str, code: str, label: str) -> DataFrame:
        return entries.where(F.col("section") == name).select(
            F.col("code").alias(code), F.col("label").alias(label)
        )

    maps = {
        layout.COUNTRY_MAP: section(layout.COUNTRY_SECTION, "country_code", "country_name"),
        layout.STATE_MAP: section(layout.STATE_SECTION, "state_code", "state_name"),
        layout.TRANSPORT_MAP: section(
            layout.TRANSPORT_SECTION, "transport_code", "transport_type"
        ),
        layout.PORT_MAP: split_places(section(layout.PORT_SECTION, "port_code", "label")),
        layout.VISA_MAP: literal_map(spark, layout.VISA_TYPES, "visa_code", "visa_type"),
    }
    clean = {spec: _checked(df, spec) for spec, df in maps.items()}
    result = CodeMaps(
        country=cluster_unknown(clean[layout.COUNTRY_MAP]),
        # Texts like 7 and 07 are one code; as in the dimension, neither label is kept.
        country_members=unique_guard(
            country_members(clean[layout.COUNTRY_MAP]).distinct(), ["country_code"]
        ),
        state=clean[layout.STATE_MAP],
        transport=clean[layout.TRANSPORT_MAP],
        port=clean[layout.PORT_MAP],
        visa=clean[layout.VISA_MAP],
        exported=clean,
    )
    result.country.createOrReplaceTempView(layout.COUNTRY_MAP.view)
    result.state.createOrReplaceTempView(layout.STATE_MAP.view)
    result.transport.createOrReplaceTempView(layout.TRANSPORT_MAP.view)
    result.port.createOrReplaceTempView(layout.PORT_MAP.view)
    result.visa.createOrReplaceTempView(layout.VISA_MAP.view)
    return result
