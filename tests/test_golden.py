"""The whole build on the hand-made sources."""

import pytest
from pyspark.sql import functions as F

import fixture
from starkit.__main__ import main
from starkit.plans import layout, reports
from starkit.plans.model import BuildConfig, current_folder, load_model, run_build, stage_sources
from starkit.sources.mapfiles import read_code_map


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    return fixture.write_fixture(spark, tmp_path_factory.mktemp("sources"))


@pytest.fixture(scope="module")
def config(paths, tmp_path_factory):
    return BuildConfig(**paths, target=str(tmp_path_factory.mktemp("model")))


@pytest.fixture(scope="module")
def built(spark, config):
    tables, metrics = run_build(spark, config)
    return load_model(spark, config.target), metrics


@pytest.fixture(scope="module")
def tables(built):
    return built[0]


def test_malformed_demographics_are_not_counted(spark, config):
    sources, _ = stage_sources(spark, config)
    assert sources.demographics.count() == 7
    assert len(sources.demographics.collect()) == 7


def test_code_maps(spark, config):
    sources, _ = stage_sources(spark, config)
    maps = sources.maps
    assert rows(maps.port, "port_code", "port_name", "port_state") == [
        ("LOS", "LOS ANGELES", "CA"),
        ("NYC", "NEW YORK", "NY"),
        ("SFR", "SAN FRANCISCO", "CA"),
    ]
    assert rows(maps.country) == [*fixture.COUNTRY, (9999, "Unknown Country")]
    assert rows(maps.transport) == [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")]
    assert rows(maps.state) == [("CA", "CALIFORNIA"), ("FL", "FLORIDA"), ("NY", "NEW YORK")]
    assert rows(spark.table("map_visa")) == [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]


def test_exported_maps_read_back(spark, config, tables):
    exported = read_code_map(
        spark, f"{current_folder(spark, config.target)}/i94port.csv", "port_code string, port_name string, port_state string"
    )
    assert rows(exported) == rows(spark.table("map_port"))
    countries = read_code_map(
        spark, f"{current_folder(spark, config.target)}/i94cit_res.csv", "country_code string, country_name string"
    )
    assert ("403", "INVALID: STATELESS") in rows(countries)


def test_dimensions(tables):
    assert rows(tables["dim_arrival_location"]) == fixture.LOCATION
    assert rows(tables["dim_origin_country"]) == fixture.COUNTRY
    assert rows(tables["dim_arrival_date"]) == fixture.DATES
    assert [r[0] for r in rows(tables["dim_junk_visa_transport"], "id")] == fixture.JUNK_IDS
    found = rows(
        tables["dim_demographics"], "id", "port_code", "city",
        F.round("median_age", 1).cast("string").cast("double"), "total_population",
        "hispanic_latino_population", "white_population", "african_american_population",
        "native_population", "asian_population",
    )
    assert found == fixture.DEMOGRAPHICS_ROWS


def test_columns_and_types(tables):
    for spec in layout.TABLES:
        assert tables[spec.view].columns == spec.columns
    types = dict(tables["dim_demographics"].dtypes)
    assert types["id"] == "bigint"
    assert types["median_age"] == "float"
    assert types["average_household_size"] == "double"
    assert types["asian_population"] == "bigint"
    fact_types = dict(tables["fact_immigration"].dtypes)
    assert fact_types["id"] == "bigint"
    assert fact_types["arrival_date_id"] == "int"
    assert fact_types["visa_transport_id"] == "int"


def test_fact(tables):
    fact = tables["fact_immigration"]
    assert rows(fact.drop("id")) == fixture.FACT
    assert fact.select("id").distinct().count() == len(fixture.FACT)


def test_metrics(built):
    counted = {m.table: m.rows for m in built[1] if m.rows is not None}
    assert counted == {
        "dim_arrival_location": 3,
        "dim_demographics": 3,
        "dim_origin_country": 3,
        "dim_arrival_date": 3,
        "dim_junk_visa_transport": 12,
        "fact_immigration": 5,
    }
    assert all(m.seconds >= 0 for m in built[1])
    # Two cities share the port LOS.
    assert {m.table: m.fanout_keys for m in built[1] if m.fanout_keys} == {"dim_demographics": 1}


def test_users_sql_runs_on_the_views(spark, tables):
    found = spark.sql(
        """SELECT l.port_name, d.dayofweek_name, v.visa_type, c.country_name, p.city,
            count(DISTINCT f.id) AS visits
        FROM fact_immigration AS f
        INNER JOIN dim_arrival_location AS l ON l.id = f.arrival_location_id
        INNER JOIN dim_arrival_date AS d ON d.arrdate = f.arrival_date_id
        INNER JOIN dim_junk_visa_transport AS v ON v.id = f.visa_transport_id
        INNER JOIN dim_origin_country AS c ON c.country_id = f.country_id_residence
        INNER JOIN dim_demographics AS p ON p.id = f.arrlocation_demographics_id
        GROUP BY ALL"""
    )
    assert rows(found) == [
        ("LOS ANGELES", "Sat", "Student", "JAPAN", "Los Angeles", 2),
        ("NEW YORK", "Fri", "Pleasure", "UNITED KINGDOM", "New York", 1),
        ("NEW YORK", "Fri", "Student", "CHINA, PRC", "New York", 1),
        ("NEW YORK", "Sun", "Pleasure", "UNITED KINGDOM", "New York", 1),
    ]


def test_command_line(spark, paths, tmp_path, monkeypatch, capsys):
    arguments = [
        "starkit", "--feed", paths["feed_path"], "--demographics", paths["demographics_path"],
        "--labels", paths["labels_path"], "--target", str(tmp_path / "model"),
    ]
    monkeypatch.setattr("sys.argv", arguments)
    main()
    assert "fact_immigration: 5 rows" in capsys.readouterr().out
    assert rows(load_model(spark, str(tmp_path / "model"))["fact_immigration"].drop("id")) == fixture.FACT


def test_equal_country_codes_in_two_spellings(spark, paths, tmp_path):
    """135 and 0135 are one code with two labels, so neither is kept."""
    labels = tmp_path / "labels.sas"
    labels.write_text(fixture.LABELS.replace("   403 =", "   0135 = 'ELSEWHERE'\n   403 ="))
    for option in ("drop", "member"):
        config = BuildConfig(
            **{**paths, "labels_path": str(labels)}, target=str(tmp_path / option),
            unknown_countries=option, export_maps=False,
        )
        tables, _ = run_build(spark, config)
        assert 135 not in [r[0] for r in rows(tables["dim_origin_country"])]
        assert {r[4] for r in tables["fact_immigration"].collect()} == {245}


def test_unknown_member(spark, paths, tmp_path):
    config = BuildConfig(
        **paths, target=str(tmp_path / "model"), unknown_countries="member", export_maps=False
    )
    tables, _ = run_build(spark, config)
    assert rows(tables["dim_origin_country"]) == [*fixture.COUNTRY, (9999, "Unknown Country")]
    kept = (2, 20547, 1021, 9999, 135, 3, 50, 1966, "F", "BA")
    assert rows(tables["fact_immigration"].drop("id")) == sorted([*fixture.FACT, kept], key=str)


@pytest.mark.parametrize("keys", ["positional", "stable"])
def test_partitioned_fact(spark, paths, tmp_path, keys):
    config = BuildConfig(
        **paths, target=str(tmp_path / "model"), partition_fact=True, fact_keys=keys, export_maps=False
    )
    tables, _ = run_build(spark, config)
    fact = tables["fact_immigration"]
    columns = [c for c in layout.FACT.columns if c != "id"]
    assert rows(fact, *columns) == fixture.FACT
    assert rows(fact.select("arrival_year", "arrival_month").distinct()) == [(2016, 4)]
    assert fact.select("id").distinct().count() == len(fixture.FACT)
    assert load_model(spark, config.target)["fact_immigration"].columns == fact.columns


def test_stable_fact_ids_do_not_depend_on_partitions(spark, paths, tmp_path):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for number, partitions in enumerate(["3", "11"]):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            config = BuildConfig(
                **paths, target=str(tmp_path / f"m{number}"), fact_keys="stable", export_maps=False
            )
            tables, _ = run_build(spark, config)
            found.append({spec.view: rows(tables[spec.view]) for spec in layout.TABLES})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_reports(tables):
    assert rows(reports.top_origins(tables)) == [("CHINA, PRC", 3), ("JAPAN", 1), ("UNITED KINGDOM", 1)]
    busiest = reports.busiest_weekday(tables, "NEW YORK", 2016, 4)
    assert rows(busiest) == [("Fri", "NEW YORK", 2)]
    shares = reports.origin_vs_share(tables, "CHINA, PRC")
    assert rows(shares, "citizenship", "city", "amount_visitor", "ratio") == [
        ("CHINA, PRC", "LOS ANGELES", 1, None),
        ("CHINA, PRC", "LOS ANGELES", 1, 12.92),
        ("CHINA, PRC", "NEW YORK", 1, 15.26),
    ]
    purpose = reports.top_locations_by_purpose(tables, ["Student"])
    assert rows(purpose, "city", "amount") == [("LOS ANGELES", 2), ("NEW YORK", 1)]
    assert rows(reports.by_mode(tables)) == [("Air", 4), ("Land", 1)]
    ages = reports.bucket_by_location(tables)
    assert rows(ages, "city", "age_group", "visitor_amount") == [
        ("LOS ANGELES", 20, 2),
        ("NEW YORK", None, 1),
        ("NEW YORK", 20, 1),
        ("NEW YORK", 40, 1),
    ]
    assert reports.inspect(tables, "dim_arrival_date", 2).count() == 2
