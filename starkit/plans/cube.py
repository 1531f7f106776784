"""Visits counted in advance for every report.

One aggregate with grouping sets counts the fact by the few combinations of foreign keys that
the reports use. Each combination is stored as a partition of its own, so a report reads one.
Counts add up: each part of a fact that grows day by day has its own cube, and reports sum
over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed
from starkit.plans import layout
from starkit.plans.builds import current_build
from starkit.plans.sqltables import write_counted

# Name -> foreign keys. Whatever a report counts by is part of one of them.
GROUPING_SETS: dict[str, tuple[str, ...]] = {
    "place_origin": ("arrival_location_id", "arrlocation_demographics_id", "country_id_citizenship"),
    "place_day": ("arrival_location_id", "arrival_date_id"),
    "place_kind": ("arrival_location_id", "visa_transport_id"),
    "place_age": ("arrival_location_id", "immigrant_age"),
    "origins": ("country_id_citizenship", "country_id_residence"),
}
VISITS = "visits"
CUBE_VIEW, CUBE_DIRECTORY = "cube_immigration", "cube.parquet"
_SET = "grouping_set"

KEYS = tuple(dict.fromkeys(key for keys in GROUPING_SETS.values() for key in keys))
_SCHEMA = ", ".join(f"{key} {layout.FACT.schema[key]}" for key in KEYS)
_SCHEMA = f"{_SCHEMA}, {VISITS} bigint, {_SET} string"


def cube(fact: DataFrame) -> DataFrame:
    """``(keys..., visits, grouping_set)`` of all grouping sets from one scan of the fact; keys
    that a set does not have are null. Null keys of fact rows are counted as a group."""
    sets = [[F.col(key) for key in keys] for keys in GROUPING_SETS.values()]
    counted = fact.groupingSets(sets, *KEYS).agg(
        F.count(F.lit(1)).alias(VISITS), F.grouping_id(*KEYS).alias("_id")
    )
    name = F.lit(None).cast("string")
    for set_name, keys in GROUPING_SETS.items():
        bits = "".join("0" if key in keys else "1" for key in KEYS)
        name = F.when(F.col("_id") == int(bits, 2), set_name).otherwise(name)
    return counted.select(*KEYS, VISITS, name.alias(_SET))


def write_cube(fact: DataFrame, folder: str) -> int:
    """Write the cube of a fact, or of a part of one, beside it; the number of its rows."""
    return write_counted(cube(fact), f"{folder}/{CUBE_DIRECTORY}", (_SET,))


def load_cube(spark: SparkSession, target: str) -> DataFrame:
    """The cube of the published model, of all parts of its fact, registered as a view."""
    current = current_build(spark, target)
    folders = list(dict.fromkeys(part.split("/")[0] for part in current.fact_parts))
    try:
        parts = [
            spark.read.schema(_SCHEMA).parquet(f"{target}/{folder}/{CUBE_DIRECTORY}") for folder in folders
        ]
    except Exception as error:
        raise CheckFailed(f"{target}: not every part of the fact has a cube") from error
    df = parts[0]
    for part in parts[1:]:
        df = df.union(part)
    df.createOrReplaceTempView(CUBE_VIEW)
    return df


def facts_for(tables: dict[str, DataFrame], *keys: str) -> DataFrame:
    """What a report counts: the stored counts of the smallest set with all ``keys`` where
    ``tables`` have a cube, and else the fact."""
    if CUBE_VIEW not in tables:
        return tables[layout.FACT.view]
    fitting = [(len(have), name) for name, have in GROUPING_SETS.items() if set(keys) <= set(have)]
    if not fitting:
        return tables[layout.FACT.view]
    name = min(fitting)[1]
    return tables[CUBE_VIEW].filter(F.col(_SET) == name).select(*GROUPING_SETS[name], VISITS)
