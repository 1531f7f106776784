"""Names of views, columns and files that users' queries rely on."""

from __future__ import annotations

from dataclasses import dataclass

# Staging views and their expected number of columns.
FEED_VIEW = "staging_immigration_table"
FEED_COLUMNS = 28
DEMOGRAPHICS_VIEW = "staging_demographics_table"
DEMOGRAPHICS_COLUMNS = 12

# Columns read from the feed.
PORT = "i94port"
STATE = "i94addr"
CITIZENSHIP = "i94cit"
RESIDENCE = "i94res"
ARRIVAL_DAY = "arrdate"
VISA = "i94visa"
TRANSPORT = "i94mode"
AGE = "i94bir"
BIRTH_YEAR = "biryear"
GENDER = "gender"
AIRLINE = "airline"

USED_COLUMNS = (
    PORT, STATE, CITIZENSHIP, RESIDENCE, ARRIVAL_DAY, VISA, TRANSPORT, AGE, BIRTH_YEAR, GENDER,
    AIRLINE,
)

# Sections of the label text.
COUNTRY_SECTION = "i94cntyl"
PORT_SECTION = "i94prtl"
TRANSPORT_SECTION = "i94model"
STATE_SECTION = "i94addrl"

VISA_TYPES = {"1": "Business", "2": "Pleasure", "3": "Student"}

# Pivot value -> column of the population groups.
GROUPS = {
    "Hispanic or Latino": "hispanic_latino_population",
    "White": "white_population",
    "Black or African-American": "african_american_population",
    "American Indian and Alaska Native": "native_population",
    "Asian": "asian_population",
}


@dataclass(frozen=True)
class MapSpec:
    """A code map: its view, columns in order, and file name when exported."""

    view: str
    columns: tuple[str, ...]
    file: str


COUNTRY_MAP = MapSpec("map_cit_res", ("country_code", "country_name"), "i94cit_res.csv")
STATE_MAP = MapSpec("map_addr", ("state_code", "state_name"), "i94addr.csv")
TRANSPORT_MAP = MapSpec(
    "map_transport_mode", ("transport_code", "transport_type"), "i94mode.csv"
)
PORT_MAP = MapSpec("map_port", ("port_code", "port_name", "port_state"), "i94port.csv")
VISA_MAP = MapSpec("map_visa", ("visa_code", "visa_type"), "i94visa.csv")


@dataclass(frozen=True)
class TableSpec:
    """A table of the star: its view, schema, directory and key."""

    view: str
    schema: dict[str, str]  # column -> type, in order
    directory: str
    key: str

    @property
    def columns(self) -> list[str]:
        return list(self.schema)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.schema.items())


LOCATION = TableSpec(
    "dim_arrival_location",
    {"id": "bigint", "port_code": "string", "state_code": "string", "port_name": "string"},
    "arrival_location.parquet",
    "id",
)
DEMOGRAPHICS = TableSpec(
    "dim_demographics",
    {
        "id": "bigint",
        "port_code": "string",
        "city": "string",
        "state": "string",
        "state_code": "string",
        "median_age": "float",
        "male_population": "bigint",
        "female_population": "bigint",
        "total_population": "bigint",
        "number_of_veterans": "bigint",
        "foreign_born": "bigint",
        "average_household_size": "double",
        **{name: "bigint" for name in GROUPS.values()},
    },
    "demographics.parquet",
    "id",
)
COUNTRY = TableSpec(
    "dim_origin_country",
    {"country_id": "int", "country_name": "string"},
    "origin_country.parquet",
    "country_id",
)
DATE = TableSpec(
    "dim_arrival_date",
    {
        "arrdate": "int",
        "arrdate_conv": "string",
        "year": "int",
        "month": "int",
        "dayofmonth": "int",
        "dayofweek": "int",
        "dayofweek_name": "string",
        "dayofyear": "int",
        "weekofyear": "int",
        "quarter": "int",
    },
    "arrival_date.parquet",
    "arrdate",
)
JUNK = TableSpec(
    "dim_junk_visa_transport",
    {
        "id": "int",
        "visa_code": "int",
        "transport_code": "int",
        "visa_type": "string",
        "transport_type": "string",
    },
    "junk_visa_transport.parquet",
    "id",
)
FACT = TableSpec(
    "fact_immigration",
    {
        "id": "bigint",
        "arrival_location_id": "bigint",
        "arrival_date_id": "int",
        "visa_transport_id": "int",
        "country_id_citizenship": "int",
        "country_id_residence": "int",
        "arrlocation_demographics_id": "bigint",
        "immigrant_age": "int",
        "immigrant_birthyear": "int",
        "immigrant_gender": "string",
        "airline": "string",
    },
    "immigration.parquet",
    "id",
)
TABLES = (LOCATION, DEMOGRAPHICS, COUNTRY, DATE, JUNK, FACT)

# Under a target: one folder for each build, and the log of those that were completed.
BUILD_PREFIX = "build-"
PUBLISHED = "published"
# Under a build that keeps lost feed rows: fact and rejects as partitions of one table.
SPLIT = "split.parquet"
FACT_PART, REJECT_PART = f"{SPLIT}/rejected=false", f"{SPLIT}/rejected=true"
