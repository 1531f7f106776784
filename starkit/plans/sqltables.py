"""Tables given as SQL over the registered views, built in order."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed, require_columns
from starkit.plans import layout
from starkit.plans.builds import publish, published
from starkit.plans.metrics import TableMetrics

# The kind of these builds in a target's log.
SQL_BUILD = "sql"


@dataclass(frozen=True)
class SqlTable:
    """A table's view, its statement, its number of columns and its directory."""

    view: str
    sql: str
    columns: int
    directory: str


def write_counted(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite a parquet table and return its rows, counted while they are written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def build_sql_tables(
    spark: SparkSession, specs: list[SqlTable], target: str
) -> tuple[dict[str, DataFrame], list[TableMetrics]]:
    """Run, check and write the tables in order, then publish and register them together.

    A statement runs once: its rows are counted while they are written, and an empty table
    fails afterwards. Later statements see the written tables under their views' names, so
    they neither repeat earlier ones nor see other generated ids than those stored. If one
    fails, the views are what they were, and ``load_sql_tables`` gives the earlier build.
    """
    build = f"{layout.BUILD_PREFIX}{uuid.uuid4().hex}"
    before = {
        spec.view: spark.table(spec.view) if spark.catalog.tableExists(spec.view) else None
        for spec in specs
    }
    tables: dict[str, DataFrame] = {}
    metrics = []
    try:
        for spec in specs:
            started = time.monotonic()
            df = spark.sql(spec.sql)
            require_columns(df, spec.view, spec.columns)
            path = f"{target}/{build}/{spec.directory}"
            rows = write_counted(df, path)
            if not rows:
                raise CheckFailed(f"{spec.view}: no rows")
            tables[spec.view] = spark.read.schema(df.schema).parquet(path)
            tables[spec.view].createOrReplaceTempView(spec.view)
            metrics.append(TableMetrics(spec.view, rows, time.monotonic() - started))
        publish(spark, target, build, SQL_BUILD, ())
    except BaseException:
        for view in tables:
            if before[view] is None:
                spark.catalog.dropTempView(view)
            else:
                before[view].createOrReplaceTempView(view)
        raise
    return tables, metrics


def load_sql_tables(spark: SparkSession, specs: list[SqlTable], target: str) -> dict[str, DataFrame]:
    """The tables of the last completed build, registered under their views' names."""
    entries = published(spark, target, SQL_BUILD)
    if not entries:
        raise CheckFailed(f"{target}: no build was published")
    tables = {spec.view: spark.read.parquet(f"{target}/{entries[0].build}/{spec.directory}") for spec in specs}
    for view, df in tables.items():
        df.createOrReplaceTempView(view)
    return tables
