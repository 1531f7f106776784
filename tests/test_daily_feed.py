"""The daily builds' feed: joined and written once, each row in one delivery."""

from starkit.plans.builds import INCREMENTAL, published
from workload import features, visits

SF_DIR = "/root/testdata/sf0.001"


def test_daily_builds_join_the_feed_once(spark, monkeypatch):
    calls, frames = [], []

    def counted(*args):
        calls.append(args)
        frames.append(plain(*args))
        return frames[-1]

    plain = visits.visit_feed
    for module in (visits, features):
        monkeypatch.setattr(module, "visit_feed", counted, raising=False)
    monkeypatch.setattr(features, "_daily", {})
    target, folders = features._daily_target(spark, SF_DIR)
    assert len(calls) == 1
    assert len(folders) == len(published(spark, target, INCREMENTAL)) == 3
    listed = spark.read.parquet(f"{folders[-1]}/feed_files.parquet")
    files = [row["path"] for row in listed.collect()]
    stored = spark.read.parquet(*files)
    assert stored.columns == frames[0].columns
    assert stored.exceptAll(frames[0]).isEmpty() and frames[0].exceptAll(stored).isEmpty()


def test_visits_deal_lines_once(spark):
    """Where no side is small, the lines are joined to orders that have their customers."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        plan = visits.visit_feed(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, before)
    lines = next(i for i, row in enumerate(plan.splitlines()) if "l_orderkey" in row and "Relation" in row)
    depth = {i: len(row) - len(row.lstrip(" :+-")) for i, row in enumerate(plan.splitlines())}
    joins = [i for i, row in enumerate(plan.splitlines()) if "Join Inner" in row and i < lines and depth[i] < depth[lines]]
    assert len(joins) == 2, plan
