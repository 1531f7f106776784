"""Operators against plain Python on small data, with hot keys and copies."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starkit.functions import number_to_int, text_to_long, whole_code
from starkit.operators.guards import duplicate_keys, unique_guard, unique_guard_nonnull
from starkit.operators.keys import dense_key, dense_row_key, hash_bucket, positional_key, row_key
from starkit.operators.lookup import Lookup, reject_report, star_lookup
from starkit.operators.pivot import pivot_sum
from starkit.sources.staging import normalize_column_names


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows are copies of one row; the rest have repeated keys."""
    return (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 700).alias("k"),
            F.when(F.col("id") % 3 == 0, "same").otherwise((F.col("id") % 11).cast("string")).alias("v"),
            F.when(F.col("id") % 3 != 0, F.col("id") % 1300).alias("n"),
        )
        .repartition(6)
    )


def window_guard(df, keys, counted="*"):
    w = Window.partitionBy(*keys)
    return df.withColumn("c", F.count(counted).over(w)).where("c = 1").drop("c")


@pytest.mark.parametrize("keys", [["k"], ["k", "v"], ["k", "n"], ["n"]])
def test_unique_guard_equals_the_window_form(hot, keys):
    assert rows(unique_guard(hot, keys)) == rows(window_guard(hot, keys))


@pytest.mark.parametrize("keys", [["k"], ["n", "v"]])
def test_unique_guard_nonnull_equals_the_window_form(spark, keys):
    df = spark.createDataFrame(
        [(1, "a", 10, "x"), (1, "a", None, "y"), (1, "a", None, "y"), (2, "b", 1, "x"), (2, "b", 2, "x"),
         (None, None, 5, "x"), (None, None, None, "z"), (3, "c", None, "w")],
        "k int, v string, m int, n string",
    )
    assert rows(unique_guard_nonnull(df, keys, "m")) == rows(window_guard(df, keys, "m"))


def test_duplicate_keys(hot):
    counted = Counter(r.k for r in hot.collect())
    assert rows(duplicate_keys(hot, ["k"])) == sorted(
        [(k, n) for k, n in counted.items() if n > 1], key=lambda r: [(True, str(v)) for v in r]
    )


def test_dense_key_follows_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(7)
    assert [(r.id, r.x) for r in dense_key(df, ["x"]).orderBy("id").collect()] == [
        (n + 1, n) for n in range(1000)
    ]


@pytest.mark.parametrize("span", [1, 7, 100_000])
def test_row_keys_are_unique_and_keep_every_copy(hot, span):
    keyed = row_key(hot, copy_span=span)
    assert keyed.columns == ["id", *hot.columns]
    found = keyed.collect()
    assert len({r.id for r in found}) == 3000
    assert Counter(tuple(r)[1:] for r in found) == Counter(tuple(r) for r in hot.collect())


def test_row_keys_depend_on_the_rows_alone(hot):
    assert rows(row_key(hot)) == rows(row_key(hot.repartition(3, "v")))


@pytest.mark.parametrize("span", [7, 100_000])
def test_dense_row_keys_are_one_to_n(hot, span):
    keyed = dense_row_key(hot, copy_span=span, buckets=16)
    assert sorted(r.id for r in keyed.collect()) == list(range(1, 3001))
    assert rows(keyed) == rows(dense_row_key(hot.repartition(2), copy_span=span, buckets=16))


def test_copies_spread_over_buckets(hot):
    """Spans of one hot row fall into many buckets."""
    copies = row_key(hot, copy_span=10).where("k = -1")
    buckets = copies.select(F.shiftright("id", 40).alias("b")).groupBy("b").count().collect()
    assert len(buckets) > 90
    assert max(r["count"] for r in buckets) <= 20


def test_bucket_count_must_be_a_power_of_16():
    with pytest.raises(ValueError):
        hash_bucket(["x"], 1000)


def test_positional_keys_are_unique_once_written(hot, spark, tmp_path):
    positional_key(hot).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.select("id").distinct().count() == 3000


def test_pivot_keeps_groups_without_listed_values(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", "y", 5), ("b", "z", 9), (None, None, 3)],
        "g string, p string, v int",
    )
    wide = pivot_sum(df, "p", F.col("v"), {"x": "sum_x", "y": "sum_y"}, "v")
    assert rows(wide) == [(None, None, None), ("a", 3, 5), ("b", None, None)]


def test_lookup_and_rejects(spark):
    feed = spark.createDataFrame([(1, "a"), (2, "b"), (2, "z"), (9, "a"), (None, "a")], "x int, y string")
    # Null keys match nothing, however many there are.
    numbers = spark.createDataFrame([(1, 10), (2, 20), (None, 30), (None, 40)], "k int, id int")
    first = Lookup("first", numbers, {"k": F.col("x")}, {"id": "first_id"})
    second = Lookup(
        "second", spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, id int"),
        {"k": F.col("y")}, {"id": "second_id"}, allow_fanout=True,
    )
    assert rows(star_lookup(feed, [first, second])) == [(1, "a", 10, 1), (2, "b", 20, 2), (2, "b", 20, 3)]
    assert rows(reject_report(feed, [first, second])) == [("any", 5, 3), ("first", 5, 2), ("second", 5, 1)]


def test_whole_codes_and_tolerant_numbers(spark):
    df = spark.createDataFrame([("135.0",), ("135.5",), ("x",), (None,), ("12.",)], "t string")
    text = F.col("t")
    found = df.select(whole_code(text), text_to_long(text), number_to_int(text)).collect()
    assert [tuple(r) for r in found] == [
        (135, 135, 135), (None, 135, 135), (None, None, None), (None, None, None), (12, 12, 12),
    ]


def test_normalized_names_must_not_collide(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a-b` int")
    with pytest.raises(ValueError):
        normalize_column_names(df)
