"""Properties of the star built from the test tables."""

import pytest
from pyspark.sql import functions as F

from starkit.plans import layout, reports
from starkit.plans.model import load_model
from workload.visits import model_for, sources_for

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return load_model(spark, model_for(spark, SF_DIR))


def test_fact_is_no_larger_than_the_feed(spark, tables):
    assert tables[layout.FACT.view].count() <= sources_for(spark, SF_DIR).feed.count()


@pytest.mark.parametrize(
    "link",
    [reports.LOCATION, reports.DATE, reports.CITIZENSHIP, reports.RESIDENCE, reports.VISIT_KIND, reports.CITY_PROFILE],
)
def test_every_foreign_key_exists(tables, link):
    fact, dimension = tables[layout.FACT.view], tables[link.view]
    orphans = fact.join(dimension, F.col(link.foreign_key) == dimension[link.key], "left_anti")
    assert orphans.count() == 0


@pytest.mark.parametrize("spec", [layout.LOCATION, layout.DEMOGRAPHICS])
def test_dimension_ids_are_one_to_n(tables, spec):
    ids = sorted(r.id for r in tables[spec.view].select("id").collect())
    assert ids == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("spec", layout.TABLES)
def test_keys_are_unique_and_present(tables, spec):
    df = tables[spec.view]
    assert df.select(spec.key).distinct().na.drop().count() == df.count()


@pytest.mark.parametrize(
    "report", [reports.season_histogram, reports.bucket_by_location, reports.by_purpose, reports.by_mode, reports.by_origin_pair]
)
def test_reports_account_for_every_row(tables, report):
    total = report(tables).agg(F.sum("visitor_amount")).first()[0]
    assert total == tables[layout.FACT.view].count()
