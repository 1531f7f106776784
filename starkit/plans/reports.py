"""Questions answered on a loaded star.

Counts are taken per foreign key first and labelled afterwards: the fact is
reduced map-side to a few rows per task before a label is joined. Conditions on
dimensions become semi joins that thin the fact out first. With a cube among the tables
(``cube.load_cube``) its counts are added up instead, and the fact is not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions import percent
from starkit.plans import layout
from starkit.plans.cube import VISITS, facts_for

# The names of result columns below (``visitor_amount``, ``arrival_day``, ``amount``,
# ``citizenship``, ``city``, ``ratio``, ...) are fixed values that users' SQL relies on.

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Link:
    """A foreign key of the fact and the dimension key it refers to."""

    view: str
    foreign_key: str
    key: str


LOCATION = Link(layout.LOCATION.view, "arrival_location_id", "id")
DATE = Link(layout.DATE.view, "arrival_date_id", "arrdate")
CITIZENSHIP = Link(layout.COUNTRY.view, "country_id_citizenship", "country_id")
RESIDENCE = Link(layout.COUNTRY.view, "country_id_residence", "country_id")
VISIT_KIND = Link(layout.JUNK.view, "visa_transport_id", "id")
CITY_PROFILE = Link(layout.DEMOGRAPHICS.view, "arrlocation_demographics_id", "id")


def _only(fact: DataFrame, tables: Tables, link: Link, condition: Column) -> DataFrame:
    """Fact rows whose dimension row meets ``condition``."""
    wanted = tables[link.view].where(condition).select(F.col(link.key).alias("_wanted"))
    return fact.join(wanted, F.col(link.foreign_key) == F.col("_wanted"), "left_semi")


def _count(
    fact: DataFrame,
    tables: Tables,
    labels: dict[Link, dict[str, Column]],
    measure: str,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Count fact rows, or add up stored counts, by labels of the linked dimensions and by
    ``extra`` expressions."""
    extra = extra or {}
    foreign_keys = [link.foreign_key for link in labels]
    rows = F.sum(VISITS) if VISITS in fact.columns else F.count(F.lit(1))
    counted = fact.groupBy(
        *foreign_keys, *[expression.alias(name) for name, expression in extra.items()]
    ).agg(rows.alias("_rows"))
    for number, (link, columns) in enumerate(labels.items()):
        key = f"_key_{number}"
        names = tables[link.view].select(
            F.col(link.key).alias(key),
            *[expression.alias(name) for name, expression in columns.items()],
        )
        counted = counted.join(names, F.col(link.foreign_key) == F.col(key))
    groups = [name for columns in labels.values() for name in columns]
    return counted.groupBy(*groups, *extra).agg(F.sum("_rows").alias(measure))


def _top(df: DataFrame, measure: str, k: int) -> DataFrame:
    """The ``k`` largest rows; ties go by the other columns, so the result is fixed."""
    others = [c for c in df.columns if c != measure]
    return df.orderBy(F.desc(measure), *others).limit(k)


def _facts(tables: Tables, *links: Link) -> DataFrame:
    return facts_for(tables, *[link.foreign_key for link in links])


def _city() -> dict[Link, dict[str, Column]]:
    return {LOCATION: {"city": F.col("port_name")}}


def top_locations(tables: Tables, k: int = 5) -> DataFrame:
    """Cities with the most visitors."""
    fact = _facts(tables, LOCATION)
    return _top(_count(fact, tables, _city(), "visitor_amount"), "visitor_amount", k)


def busiest_weekday(tables: Tables, city: str, year: int, month: int, k: int = 1) -> DataFrame:
    """The weekday with the most arrivals in one city and month."""
    in_month = (F.col("month") == month) & (F.col("year") == year)
    fact = _facts(tables, LOCATION, DATE)
    if "arrival_month" in fact.columns:
        # A fact partitioned by month is read for that month only.
        fact = fact.where((F.col("arrival_year") == year) & (F.col("arrival_month") == month))
    fact = _only(fact, tables, LOCATION, F.col("port_name") == city)
    fact = _only(fact, tables, DATE, in_month)
    labels = {DATE: {"arrival_day": F.col("dayofweek_name")}, **_city()}
    return _top(_count(fact, tables, labels, "visitor_amount"), "visitor_amount", k)


def top_origins(tables: Tables, k: int = 5) -> DataFrame:
    """Citizenships with the most visits."""
    labels = {CITIZENSHIP: {"country_name": F.col("country_name")}}
    counted = _count(_facts(tables, CITIZENSHIP), tables, labels, "visitor_amount")
    return _top(counted, "visitor_amount", k)


def top_locations_for_origin(tables: Tables, origin: str, k: int = 5) -> DataFrame:
    """Cities most visited by citizens of one country."""
    fact = _only(
        _facts(tables, LOCATION, CITIZENSHIP), tables, CITIZENSHIP, F.col("country_name") == origin
    )
    return _top(_count(fact, tables, _city(), "visitor_amount"), "visitor_amount", k)


def origin_vs_share(
    tables: Tables, origin: str, group: str = "asian_population", k: int = 5
) -> DataFrame:
    """Cities most visited from one country, with a group's share of their population.

    Cities are told apart by the exact share; it is rounded for display only.
    """
    fact = _only(
        _facts(tables, LOCATION, CITY_PROFILE, CITIZENSHIP), tables, CITIZENSHIP, F.col("country_name") == origin
    )
    labels = {
        CITIZENSHIP: {"citizenship": F.col("country_name")},
        **_city(),
        CITY_PROFILE: {"ratio": percent(F.col(group), F.col("total_population"))},
    }
    counted = _count(fact, tables, labels, "amount_visitor")
    return _top(counted, "amount_visitor", k).withColumn("ratio", F.round("ratio", 2))


def top_locations_by_purpose(tables: Tables, visa_types: list[str], k: int = 5) -> DataFrame:
    """Cities most visited on the given visa types."""
    fact = _only(
        _facts(tables, LOCATION, VISIT_KIND), tables, VISIT_KIND, F.col("visa_type").isin(visa_types)
    )
    labels = {VISIT_KIND: {"visa_type": F.col("visa_type")}, **_city()}
    return _top(_count(fact, tables, labels, "amount"), "amount", k)


def share_correlation(
    tables: Tables, origins: list[str], group: str = "asian_population"
) -> DataFrame:
    """Correlation, over cities, of a group's population share and the share of
    visits by citizens of ``origins``. One row ``(locations, correlation)``."""
    labels = {
        LOCATION: {"city": F.col("port_name")},
        CITY_PROFILE: {"population_share": percent(F.col(group), F.col("total_population"))},
        CITIZENSHIP: {"from_origin": F.col("country_name").isin(origins)},
    }
    counted = _count(_facts(tables, LOCATION, CITY_PROFILE, CITIZENSHIP), tables, labels, "visits")
    shares = (
        counted.groupBy("city", "population_share")
        .agg(
            F.sum("visits").alias("visits"),
            F.sum(F.when(F.col("from_origin"), F.col("visits")).otherwise(0)).alias("origin_visits"),
        )
        .withColumn("visit_share", percent(F.col("origin_visits"), F.col("visits")))
        .where(F.col("population_share").isNotNull())
    )
    return shares.agg(
        F.count(F.lit(1)).alias("locations"),
        F.round(F.corr("population_share", "visit_share"), 6).alias("correlation"),
    )


def bucket_by_location(tables: Tables, width: int = 10) -> DataFrame:
    """Visitors by age group, named by its lower bound, and city."""
    age_group = (F.floor(F.col("immigrant_age") / width) * width).cast("int")
    fact = facts_for(tables, LOCATION.foreign_key, "immigrant_age")
    return _count(fact, tables, _city(), "visitor_amount", {"age_group": age_group})


def season_histogram(tables: Tables) -> DataFrame:
    """Visitors by quarter and city."""
    labels = {DATE: {"quarter": F.col("quarter")}, **_city()}
    return _count(_facts(tables, LOCATION, DATE), tables, labels, "visitor_amount")


def by_purpose(tables: Tables) -> DataFrame:
    """Visitors by visa type."""
    labels = {VISIT_KIND: {"visa_type": F.col("visa_type")}}
    return _count(_facts(tables, VISIT_KIND), tables, labels, "visitor_amount")


def by_mode(tables: Tables) -> DataFrame:
    """Visitors by mode of transport."""
    labels = {VISIT_KIND: {"transport_type": F.col("transport_type")}}
    return _count(_facts(tables, VISIT_KIND), tables, labels, "visitor_amount")


def by_origin_pair(tables: Tables) -> DataFrame:
    """Visitors by country of citizenship and country of residence."""
    labels = {
        CITIZENSHIP: {"citizenship": F.col("country_name")},
        RESIDENCE: {"residence": F.col("country_name")},
    }
    return _count(_facts(tables, CITIZENSHIP, RESIDENCE), tables, labels, "visitor_amount")


def inspect(tables: Tables, view: str, n: int = 10) -> DataFrame:
    """Some rows of one table."""
    return tables[view].limit(n)
