"""Build the star from its sources, write it, and load it again.

Each build writes dimensions, fact and maps into a folder of its own under the target.
When all are complete, one row in the target's log of builds makes it the model that
``load_model`` reads. Until then nothing of an earlier model is touched.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions import day_to_date, register_day_function
from starkit.operators.checks import (
    CheckFailed,
    require_columns,
    require_keys,
    require_not_empty,
    require_unique,
)
from starkit.operators.guards import duplicate_keys
from starkit.operators.keys import positional_key, row_key
from starkit.plans import layout
from starkit.plans.builds import Published, current_build, current_folder, publish, published
from starkit.plans.codemaps import CodeMaps, build_code_maps, export_code_maps
from starkit.plans.cube import CUBE_VIEW, load_cube, write_cube
from starkit.plans.dimensions import (
    country_dimension,
    country_dimension_unknown_member,
    date_dimension,
    demographics_dimension,
    junk_dimension,
    location_dimension,
    observed_places,
)
from starkit.plans.fact import Dimensions, fact_rejects, fact_rows, rows_without_day
from starkit.plans.metrics import TableMetrics
from starkit.plans.sqltables import write_counted
from starkit.session import at_once, scratch_path, scratch_root
from starkit.sources.labels import read_label_texts
from starkit.sources.staging import SourceSpec, stage


__all__ = [
    "BuildConfig", "Published", "Sources", "build_model", "current_build", "current_folder",
    "load_model", "publish", "published", "run_build", "stage_sources",
]


@dataclass(frozen=True)
class BuildConfig:
    """Sources and options of one build."""

    feed_path: str
    demographics_path: str
    labels_path: str
    target: str
    feed_columns: int = layout.FEED_COLUMNS
    demographics_columns: int = layout.DEMOGRAPHICS_COLUMNS
    demographics_schema: str | None = None
    demographics_separator: str = ";"
    unknown_countries: str = "drop"  # or "member": one common dimension row
    city_distance: int = 0  # edits by which a port's name may differ from its city's
    fact_keys: str = "positional"  # or "stable": ids that depend on the rows alone
    partition_fact: bool = False  # by arrival_year and arrival_month
    export_maps: bool = True
    map_delimiter: str = ";"
    cube: bool = False  # counts for the reports are stored with the fact
    count_rejects: bool = False  # feed rows lost per lookup, from one more pass over the feed


@dataclass(frozen=True)
class Sources:
    feed: DataFrame
    demographics: DataFrame
    maps: CodeMaps


def stage_sources(spark: SparkSession, config: BuildConfig) -> tuple[Sources, list[TableMetrics]]:
    """Stage feed and demographics and build the code maps."""
    scratch_root(spark)  # the checkpoints below need their folder
    register_day_function(spark)
    staged = stage(
        spark,
        [
            SourceSpec(layout.FEED_VIEW, config.feed_path, columns=config.feed_columns),
            SourceSpec(
                layout.DEMOGRAPHICS_VIEW,
                config.demographics_path,
                "csv",
                columns=config.demographics_columns,
                schema=config.demographics_schema,
                separator=config.demographics_separator,
            ),
        ],
    )
    started = time.monotonic()
    maps = build_code_maps(spark, read_label_texts(spark, config.labels_path))
    metrics = [TableMetrics(view, None, source.seconds) for view, source in staged.items()]
    metrics.append(TableMetrics("code_maps", None, time.monotonic() - started))
    sources = Sources(
        staged[layout.FEED_VIEW].df, staged[layout.DEMOGRAPHICS_VIEW].df, maps
    )
    return sources, metrics


def _stored(df: DataFrame, spec: layout.TableSpec, folder: str) -> DataFrame:
    """The written table, read with the schema it was written with."""
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{spec.directory}")


def checked_dimension(
    spec: layout.TableSpec, build: Callable[[], DataFrame]
) -> tuple[DataFrame, float]:
    """Build and check a dimension; return it with the seconds taken.

    The checks run on a checkpoint of the small result, so the feed is scanned once.
    """
    started = time.monotonic()
    df = build().select(*spec.columns).checkpoint()
    require_not_empty(df, spec.view)
    require_columns(df, spec.view, spec.schema)
    require_keys(df, spec.view, [spec.key])
    require_unique(df, spec.view, [spec.key])
    return df, time.monotonic() - started


def write_dimensions(
    spark: SparkSession, builds: dict[str, Callable[[], DataFrame]], folder: str
) -> tuple[dict[str, DataFrame], list[TableMetrics]]:
    """Build, check and write the dimensions, and read them back."""
    specs = [spec for spec in layout.TABLES if spec.view in builds]
    checked = at_once(
        spark, [partial(checked_dimension, spec, builds[spec.view]) for spec in specs]
    )

    def write(spec: layout.TableSpec, df: DataFrame, seconds: float) -> TableMetrics:
        started = time.monotonic()
        rows = write_counted(df, f"{folder}/{spec.directory}")
        return TableMetrics(spec.view, rows, seconds + time.monotonic() - started)

    metrics = at_once(
        spark, [partial(write, spec, *found) for spec, found in zip(specs, checked)]
    )
    tables = {spec.view: _stored(df, spec, folder) for spec, (df, _) in zip(specs, checked)}
    return tables, metrics


def write_fact(
    rows: DataFrame,
    folder: str,
    keys: str = "positional",
    partitioned: bool = False,
) -> tuple[DataFrame, TableMetrics]:
    """Number and write the fact, optionally by year and month of arrival. It is known to
    be empty from the rows counted while it is written, without a pass of its own."""
    started = time.monotonic()
    spec = layout.FACT
    fact = row_key(rows) if keys == "stable" else rows
    partition_by: tuple[str, ...] = ()
    if partitioned:
        day = day_to_date(F.col("arrival_date_id"))
        partition_by = ("arrival_year", "arrival_month")
        # Rebalancing gathers each month and splits one that outgrows a partition.
        fact = fact.withColumns(
            {"arrival_year": F.year(day), "arrival_month": F.month(day)}
        ).hint("rebalance", *partition_by)
    if keys == "positional":
        # Last, so that the ids come from the tasks that write them.
        fact = positional_key(fact)
    require_columns(fact, spec.view, {**spec.schema, **{name: "int" for name in partition_by}})
    written = write_counted(fact, f"{folder}/{spec.directory}", partition_by)
    if not written:
        raise CheckFailed(f"{spec.view}: no rows")
    return _stored(fact, spec, folder), TableMetrics(spec.view, written, time.monotonic() - started)


def build_model(
    spark: SparkSession, sources: Sources, config: BuildConfig
) -> tuple[dict[str, DataFrame], list[TableMetrics]]:
    """Dimensions first, written and read back, then the fact on top of them, then the maps.
    Only then the build is published and its tables take the views' names."""
    feed, maps = sources.feed, sources.maps
    build = f"{layout.BUILD_PREFIX}{uuid.uuid4().hex}"
    folder = f"{config.target}/{build}"
    if config.unknown_countries not in ("drop", "member"):
        raise ValueError(f"unknown_countries: {config.unknown_countries}")
    if config.fact_keys not in ("positional", "stable"):
        raise ValueError(f"fact_keys: {config.fact_keys}")
    # Both place dimensions start from these few pairs.
    places = observed_places(feed).checkpoint()

    country = country_builder(feed, maps, config)
    builds = {
        layout.LOCATION.view: partial(location_dimension, places, maps.port),
        layout.DEMOGRAPHICS.view: partial(
            demographics_dimension, places, maps.port, sources.demographics, config.city_distance
        ),
        layout.COUNTRY.view: country,
        layout.DATE.view: partial(date_dimension, feed),
        layout.JUNK.view: partial(junk_dimension, maps.transport, layout.VISA_TYPES),
    }
    tables, metrics = write_dimensions(spark, builds, folder)
    shared_ports = duplicate_keys(tables[layout.DEMOGRAPHICS.view], ["port_code"]).count()
    metrics = [
        replace(m, fanout_keys=shared_ports) if m.table == layout.DEMOGRAPHICS.view else m
        for m in metrics
    ]

    dims = lookup_dimensions(spark, tables, maps, config)
    stored, measured = write_fact(
        fact_rows(feed, dims), folder, config.fact_keys, config.partition_fact
    )
    tables[layout.FACT.view] = stored
    metrics.append(measured)
    if config.cube:
        write_cube(stored, folder)
    if config.count_rejects:
        metrics += reject_metrics(feed, dims)
    if config.export_maps:
        export_code_maps(maps, folder, config.map_delimiter)
    publish(spark, config.target, build)
    for view, df in tables.items():
        df.createOrReplaceTempView(view)
    return tables, metrics


def reject_metrics(feed: DataFrame, dims: Dimensions) -> list[TableMetrics]:
    """Feed rows lost per lookup and in all, and rows without a day, which are kept."""
    started = time.monotonic()
    lost = {r["lookup_name"]: r["rejected_rows"] for r in fact_rejects(feed, dims).collect()}
    lost["without_day"] = rows_without_day(feed)
    seconds = time.monotonic() - started
    return [TableMetrics(f"rejected:{name}", rows, seconds) for name, rows in lost.items()]


def country_builder(feed: DataFrame, maps: CodeMaps, config: BuildConfig) -> Callable[[], DataFrame]:
    if config.unknown_countries == "member":
        return partial(country_dimension_unknown_member, feed, maps.country_members)
    return partial(country_dimension, feed, maps.country)


def lookup_dimensions(
    spark: SparkSession, tables: dict[str, DataFrame], maps: CodeMaps, config: BuildConfig
) -> Dimensions:
    """The written dimensions with the country members, if the model has them."""
    dims = stored_dimensions(tables)
    if config.unknown_countries == "member":
        # Stored as well, so that its size is known when the fact joins it.
        path = scratch_path(spark, "country-members")
        maps.country_members.write.parquet(path)
        dims = replace(dims, country_members=spark.read.parquet(path))
    return dims


def stored_dimensions(tables: dict[str, DataFrame]) -> Dimensions:
    """The dimensions of a written model, as the fact's lookups need them."""
    return Dimensions(
        location=tables[layout.LOCATION.view],
        demographics=tables[layout.DEMOGRAPHICS.view],
        country=tables[layout.COUNTRY.view],
        junk=tables[layout.JUNK.view],
    )


def load_model(spark: SparkSession, target: str, cube: bool = False) -> dict[str, DataFrame]:
    """Read a written model and register its tables under their view names; with ``cube``,
    the stored counts as well, which reports then use instead of the fact."""
    register_day_function(spark)
    tables, current = {}, current_build(spark, target)
    for spec in layout.TABLES:
        paths = [f"{target}/{current.build}/{spec.directory}"]
        if spec == layout.FACT:
            paths = [f"{target}/{part}" for part in current.fact_parts]
        # A partitioned fact adds its partition columns to the declared ones.
        df = spark.read.schema(spec.ddl).parquet(*paths)
        df.createOrReplaceTempView(spec.view)
        tables[spec.view] = df
    if cube:
        tables[CUBE_VIEW] = load_cube(spark, target)
    return tables


def run_build(
    spark: SparkSession, config: BuildConfig
) -> tuple[dict[str, DataFrame], list[TableMetrics]]:
    """Stage, build the code maps, build and write the star."""
    sources, staging_metrics = stage_sources(spark, config)
    tables, table_metrics = build_model(spark, sources, config)
    return tables, staging_metrics + table_metrics
