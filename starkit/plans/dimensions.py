"""The five dimensions. Feeds are reduced to distinct codes before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.functions import (
    CALENDAR,
    day_to_date,
    day_to_iso,
    number_to_int,
    text_to_double,
    text_to_float,
    text_to_long,
    whole_code,
)
from starkit.operators.guards import unique_guard, unique_guard_nonnull
from starkit.operators.keys import dense_key, smart_key
from starkit.operators.pivot import pivot_sum
from starkit.operators.similar import nearest_names
from starkit.plans import layout

LOCATION_KEY = ["port_code", "state_code"]


def observed_places(feed: DataFrame) -> DataFrame:
    """Distinct (port, state) pairs of the feed."""
    return feed.select(layout.PORT, layout.STATE).distinct()


def _known_places(feed: DataFrame, port_map: DataFrame) -> DataFrame:
    """Observed places whose port and state both agree with the port map."""
    places = observed_places(feed)
    agree = (places[layout.PORT] == port_map["port_code"]) & (
        places[layout.STATE] == port_map["port_state"]
    )
    return places.join(port_map, agree).select("port_code", "port_state", "port_name")


def location_members(feed: DataFrame, port_map: DataFrame) -> DataFrame:
    """Ports seen in the feed, without ids; a (port, state) key with several names is left out."""
    known = _known_places(feed, port_map).withColumnRenamed("port_state", "state_code").distinct()
    return unique_guard(known, LOCATION_KEY)


def location_dimension(feed: DataFrame, port_map: DataFrame) -> DataFrame:
    """The location members, numbered by their key."""
    return dense_key(location_members(feed, port_map), LOCATION_KEY)


def demographics_wide(demographics: DataFrame) -> DataFrame:
    """One row per city with a column per population group."""
    return pivot_sum(
        demographics, "Race", F.col("Count").try_cast("double"), layout.GROUPS, "Count"
    )


def _respelled(known: DataFrame, wide: DataFrame, distance: int) -> DataFrame:
    """``known`` with ``city_name``, lower-cased: the port's name, or where no city of the state
    has it, the nearest city's within ``distance`` edits."""
    ports = known.select(F.col("port_state").alias("state"), F.lower("port_name").alias("name"))
    cities = wide.select(F.col("State Code").alias("state"), F.lower("City").alias("name"))
    nearest = nearest_names(ports, cities, ["state"], distance).select(
        F.col("state").alias("port_state"), F.col("left_name").alias("_name"), "right_name"
    )
    named = known.withColumn("_name", F.lower("port_name")).join(nearest, ["port_state", "_name"], "left")
    return named.select(*known.columns, F.coalesce("right_name", "_name").alias("city_name"))


def demographics_members(
    feed: DataFrame, port_map: DataFrame, demographics: DataFrame, distance: int = 0
) -> DataFrame:
    """Cities at the feed's ports, matched by name in any case and by state, without ids.

    A city whose other attributes differ between its rows yields several rows. With a
    ``distance``, a port without a city of its name gets the nearest one in spelling.
    """
    wide = demographics_wide(demographics)
    known = _known_places(feed, port_map)
    if distance:
        known = _respelled(known, wide, distance)
    else:
        known = known.withColumn("city_name", F.lower("port_name"))
    same_city = (F.col("city_name") == F.lower("City")) & (
        F.col("port_state") == F.col("State Code")
    )
    return (
        known.join(wide, same_city)
        .select(
            "port_code",
            F.col("City").alias("city"),
            F.col("State").alias("state"),
            F.col("State Code").alias("state_code"),
            text_to_float(F.col("Median Age")).alias("median_age"),
            text_to_long(F.col("Male Population")).alias("male_population"),
            text_to_long(F.col("Female Population")).alias("female_population"),
            text_to_long(F.col("Total Population")).alias("total_population"),
            text_to_long(F.col("Number of Veterans")).alias("number_of_veterans"),
            text_to_long(F.col("Foreign-born")).alias("foreign_born"),
            text_to_double(F.col("Average Household Size")).alias("average_household_size"),
            *[F.col(name).try_cast("bigint").alias(name) for name in layout.GROUPS.values()],
        )
        .distinct()
    )


def demographics_dimension(
    feed: DataFrame, port_map: DataFrame, demographics: DataFrame, distance: int = 0
) -> DataFrame:
    """The demographics members, numbered by all their columns."""
    cities = demographics_members(feed, port_map, demographics, distance)
    return dense_key(cities, cities.columns)


def observed_countries(feed: DataFrame) -> DataFrame:
    """Distinct codes of both country roles. Each column is read once and reduced
    before the two are put together."""
    citizenships = feed.select(F.col(layout.CITIZENSHIP).alias("code")).distinct()
    residences = feed.select(F.col(layout.RESIDENCE).alias("code")).distinct()
    return citizenships.union(residences).distinct()


def _seen_codes(feed: DataFrame) -> DataFrame:
    """Observed countries as codes; texts like 135 and 135.0 are one."""
    return observed_countries(feed).select(whole_code(F.col("code")).alias("code")).distinct()


def country_dimension(feed: DataFrame, country_map: DataFrame) -> DataFrame:
    """Countries seen in either role. Codes re-keyed as unknown match nothing."""
    seen = _seen_codes(feed)
    matched = seen.join(country_map, F.col("code") == F.col("country_id"))
    return unique_guard(matched.select("country_id", "country_name"), ["country_id"])


def country_dimension_unknown_member(feed: DataFrame, members: DataFrame) -> DataFrame:
    """As ``country_dimension``, but unknown codes share one member of the dimension."""
    seen = _seen_codes(feed)
    matched = seen.join(members, F.col("code") == F.col("country_code"))
    return unique_guard(matched.select("country_id", "country_name").distinct(), ["country_id"])


def date_dimension(feed: DataFrame) -> DataFrame:
    """Distinct arrival days with their calendar attributes; no day, no row."""
    offset = F.col(layout.ARRIVAL_DAY)
    days = feed.select(number_to_int(offset).alias(layout.ARRIVAL_DAY)).distinct()
    days = days.filter(offset.isNotNull())
    day = day_to_date(offset)
    return days.select(
        layout.ARRIVAL_DAY,
        day_to_iso(offset).alias("arrdate_conv"),
        *[attribute(day).alias(name) for name, attribute in CALENDAR.items()],
    )


def junk_dimension(transport_map: DataFrame, visa_types: dict[str, str]) -> DataFrame:
    """Every visa type with every uniquely named transport mode.

    Visa types are fixed values, so each mode fans out to a known few rows.
    """
    modes = unique_guard_nonnull(transport_map, ["transport_code"], "transport_type")
    visas = F.array(
        *[
            F.struct(F.lit(int(code)).alias("visa_code"), F.lit(label).alias("visa_type"))
            for code, label in visa_types.items()
        ]
    )
    mode = F.col("transport_code").try_cast("int")
    return modes.select("transport_code", "transport_type", F.inline(visas)).select(
        smart_key(F.col("visa_code"), mode).alias("id"),
        "visa_code",
        mode.alias("transport_code"),
        "visa_type",
        "transport_type",
    )
