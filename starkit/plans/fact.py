"""The factless fact: one row per feed row that every lookup knows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions import number_to_int, whole_code
from starkit.operators.lookup import REASONS, Lookup, reject_report, split_lookup, star_lookup
from starkit.plans import layout

# The column of ``fact_split`` that holds a lost row.
FEED_ROW = "feed_row"


@dataclass(frozen=True)
class Dimensions:
    location: DataFrame
    demographics: DataFrame
    country: DataFrame
    junk: DataFrame
    # Feed code -> member, when several codes share one; else the dimension itself.
    country_members: DataFrame | None = None


def fact_lookups(dims: Dimensions) -> list[Lookup]:
    """Location and demographics go by port alone; a port may have several cities."""
    if dims.country_members is None:
        countries, code = dims.country, "country_id"
    else:
        # Only codes whose member made it into the dimension.
        # A semi join keeps the estimate of the stored side, an inner one multiplies both.
        countries = dims.country_members.join(dims.country, "country_id", "left_semi")
        countries, code = countries.select("country_code", "country_id"), "country_code"
    port = F.col(layout.PORT)
    return [
        Lookup("location", dims.location, {"port_code": port}, {"id": "arrival_location_id"}),
        Lookup(
            "visa_transport",
            dims.junk,
            {
                "visa_code": whole_code(F.col(layout.VISA)),
                "transport_code": whole_code(F.col(layout.TRANSPORT)),
            },
            {"id": "visa_transport_id"},
        ),
        Lookup(
            "citizenship",
            countries,
            {code: whole_code(F.col(layout.CITIZENSHIP))},
            {"country_id": "country_id_citizenship"},
        ),
        Lookup(
            "residence",
            countries,
            {code: whole_code(F.col(layout.RESIDENCE))},
            {"country_id": "country_id_residence"},
        ),
        Lookup(
            "demographics",
            dims.demographics,
            {"port_code": port},
            {"id": "arrlocation_demographics_id"},
            allow_fanout=True,
        ),
    ]


def fact_rows(feed: DataFrame, dims: Dimensions, verify: bool = True) -> DataFrame:
    """The fact without its own id. Without large dimensions nothing is shuffled."""
    return star_lookup(feed, fact_lookups(dims), verify).select(*_fact_columns())


def _fact_columns() -> list[Column]:
    return [
        F.col("arrival_location_id"),
        number_to_int(F.col(layout.ARRIVAL_DAY)).alias("arrival_date_id"),
        F.col("visa_transport_id"),
        F.col("country_id_citizenship"),
        F.col("country_id_residence"),
        F.col("arrlocation_demographics_id"),
        number_to_int(F.col(layout.AGE)).alias("immigrant_age"),
        number_to_int(F.col(layout.BIRTH_YEAR)).alias("immigrant_birthyear"),
        F.col(layout.GENDER).alias("immigrant_gender"),
        F.col(layout.AIRLINE).alias("airline"),
    ]


def fact_split(feed: DataFrame, dims: Dimensions, verify: bool = True) -> DataFrame:
    """Fact rows and lost feed rows from one pass over the feed.

    A row without ``reject_reasons`` (0) is a fact row and its ``feed_row`` is null; another one
    is a feed row that a lookup lost, whole in ``feed_row``.
    """
    lost = F.when(F.col(REASONS) != 0, F.struct(*feed.columns)).alias(FEED_ROW)
    return split_lookup(feed, fact_lookups(dims), verify).select(*_fact_columns(), REASONS, lost)


def fact_rejects(feed: DataFrame, dims: Dimensions) -> DataFrame:
    """Feed rows lost per lookup."""
    return reject_report(feed, fact_lookups(dims))


def rows_without_day(feed: DataFrame) -> int:
    """Feed rows whose arrival day is unknown; the fact keeps them with a null day."""
    return feed.filter(number_to_int(F.col(layout.ARRIVAL_DAY)).isNull()).count()
