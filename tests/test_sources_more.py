"""Captured malformed rows, drifting schemas, similar names, SQL tables published together."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
)

import fixture
from starkit.operators.checks import CheckFailed
from starkit.operators import similar
from starkit.operators.similar import nearest_names, similar_names
from starkit.plans import sqltables
from starkit.plans.dimensions import demographics_members
from starkit.plans.sqltables import SqlTable, build_sql_tables, load_sql_tables
from starkit.sources.capture import capture_csv
from starkit.sources.drift import fits, read_drifting, survey, widened
from starkit.sources.staging import SourceSpec, read_source


def rows(df):
    return Counter(map(tuple, df.collect()))


# Captured rows ---------------------------------------------------------------


def csv_spec(folder, **options):
    return SourceSpec("t", str(folder), "csv", schema="a int, b string", separator=";", **options)


def test_good_rows_are_those_that_the_plain_read_keeps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text("a;b\n1;x\n\n2\n3;y;z\n   \nw;v\n;n\n4;\"q;q\"\n")
    (tmp_path / "in" / "two.csv").write_text("a;b\nbad\n5;z\n")
    captured = capture_csv(spark, csv_spec(tmp_path / "in"), tolerance=0.6)
    assert rows(captured.good) == rows(read_source(spark, csv_spec(tmp_path / "in")))
    assert captured.good.dtypes == [("a", "int"), ("b", "string")]
    found = {(r["file"].rsplit("/", 1)[1], r["record"], r["line"]) for r in captured.bad.collect()}
    assert found == {
        ("one.csv", 2, "2"),
        ("one.csv", 3, "3;y;z"),
        ("one.csv", 4, "w;v"),
        ("two.csv", 1, "bad"),
    }
    assert (captured.good_rows, captured.bad_rows) == (captured.good.count(), 4)


def test_records_are_counted_over_the_blocks_of_a_file(spark, tmp_path):
    lines = [f"{k};text {k}" if k % 50 else f"no number {k}" for k in range(1, 5001)]
    (tmp_path / "t.csv").write_text("a;b\n" + "\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        captured = capture_csv(spark, csv_spec(tmp_path / "t.csv"))
        found = {(r["record"], r["line"]) for r in captured.bad.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == {(k, f"no number {k}") for k in range(50, 5001, 50)}


def test_too_many_malformed_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;x\nbad\n")
    with pytest.raises(CheckFailed, match="1 of 2 rows are malformed"):
        capture_csv(spark, csv_spec(tmp_path / "t.csv"), tolerance=0.4)
    (tmp_path / "t.csv").write_text("a;b\n")
    with pytest.raises(CheckFailed, match="0 of 0"):
        capture_csv(spark, csv_spec(tmp_path / "t.csv"))


def test_a_source_without_a_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2\n3,y\n")
    captured = capture_csv(spark, SourceSpec("t", str(tmp_path / "t.csv"), "csv"), tolerance=0.5)
    assert rows(captured.good) == Counter([("1", "x"), ("3", "y")])
    assert [(r["record"], r["line"]) for r in captured.bad.collect()] == [(2, "2")]


# Drifting schemas --------------------------------------------------------------


@pytest.mark.parametrize(
    "one, other, wanted",
    [
        (IntegerType(), LongType(), LongType()),
        (IntegerType(), DoubleType(), DoubleType()),
        (IntegerType(), FloatType(), DoubleType()),
        (ShortType(), FloatType(), FloatType()),
        (LongType(), DoubleType(), None),  # would round
        (FloatType(), DoubleType(), DoubleType()),
        (DecimalType(10, 2), IntegerType(), DecimalType(12, 2)),
        (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)),
        (DecimalType(38, 2), LongType(), DecimalType(38, 2)),
        (DecimalType(30, 0), DecimalType(38, 20), None),
        (DateType(), TimestampNTZType(), TimestampNTZType()),
        (StringType(), IntegerType(), None),
    ],
)
def test_widening_is_exact_and_symmetric(one, other, wanted):
    assert widened(one, other) == widened(other, one) == wanted


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / name))


def test_files_of_several_schemas_become_one(spark, tmp_path):
    write(spark, tmp_path, "1", [(1, 2)], "a int, b int")
    write(spark, tmp_path, "2", [(3, 4.5)], "A long, b double")
    write(spark, tmp_path, "3", [("x", 5)], "c string, a int")
    write(spark, tmp_path, "4", [(7, 8)], "a int, b int")
    write(spark, tmp_path, "5", [("text",)], "a string")
    with pytest.raises(CheckFailed, match=r"5/part.*a: string beside bigint"):
        read_drifting(spark, str(tmp_path / "*"))
    read = read_drifting(spark, str(tmp_path / "*"), skip_incompatible=True)
    assert read.df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert rows(read.df) == Counter([(1, 2.0, None), (3, 4.5, None), (5, None, "x"), (7, 8.0, None)])
    assert read.schemas == 3 and len(read.incompatible) == 1 and "/5/" in read.incompatible[0][0]
    assert len(survey(spark, str(tmp_path / "*"))) == 5


def test_a_target_decides_what_fits(spark, tmp_path):
    write(spark, tmp_path, "1", [(1, 2)], "a int, b int")
    write(spark, tmp_path, "2", [(3, 4.5)], "a long, b double")
    target = StructType.fromDDL("a int, d string")
    read = read_drifting(spark, str(tmp_path / "*"), target, skip_incompatible=True)
    assert rows(read.df) == Counter([(1, None)])
    assert [reason for _, reason in read.incompatible] == ["a: bigint is no int"]
    assert "case" in fits(StructType.fromDDL("x int, X int"), target)
    (tmp_path / "none").mkdir()
    with pytest.raises(CheckFailed, match="no files"):
        read_drifting(spark, str(tmp_path / "none"))
    with pytest.raises(CheckFailed, match="no file fits"):
        read_drifting(spark, str(tmp_path / "2"), target, skip_incompatible=True)


# Similar names -------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def random_names(seed, count):
    rnd = random.Random(seed)
    return [(rnd.choice("uv"), "".join(rnd.choices("abé", k=rnd.randint(0, 9)))) for _ in range(count)]


@pytest.mark.parametrize("most", [1, 2])
def test_similar_names_are_all_pairs_within_the_distance(spark, most):
    left, right = random_names(most, 150) + [(None, "ab"), ("u", None)], random_names(9, 150)
    frames = [spark.createDataFrame(names, "s string, name string") for names in (left, right)]
    wanted = Counter(
        {
            (s, a, b, d): 1
            for s, a in set(left)
            for t, b in set(right)
            if s == t and None not in (s, a) and a != b and (d := distance(a, b)) <= most
        }
    )
    assert rows(similar_names(*frames, ["s"], most)) == wanted
    found = {(r["s"], r["left_name"]): tuple(r)[2:] for r in nearest_names(*frames, ["s"], most).collect()}
    best = {}
    for s, a, b, d in wanted:
        if (s, a) not in right:
            best.setdefault((s, a), []).append((d, b))
    for key, options in best.items():
        nearest, name = min(options)
        best[key] = (name, nearest, sum(d == nearest for d, _ in options) - 1)
    assert found == best


@pytest.mark.parametrize("frequent", [0, 5, 64])
def test_similar_names_of_frequent_trigrams(spark, monkeypatch, frequent):
    """Names that share their trigrams with many others, from a small alphabet: every pair is
    found, and the tokens on which they meet give few more candidates than names."""
    monkeypatch.setattr(similar, "FREQUENT", frequent)
    draw = random.Random(5)
    sides = [["".join(draw.choices("abc", k=draw.randint(1, 11))) for _ in range(200)] for _ in range(2)]
    frames = [spark.createDataFrame([("u", name) for name in names], "s string, name string") for names in sides]
    wanted = Counter(
        {("u", a, b, d): 1 for a in set(sides[0]) for b in set(sides[1]) if a != b and (d := distance(a, b)) <= 2}
    )
    assert rows(similar_names(*frames, ["s"], 2)) == wanted


def test_similar_names_meet_on_few_tokens_in_common(spark):
    """Candidates grow with the names and not with their square, though all trigrams are frequent."""
    seen = {}
    for size in (1500, 6000):
        draw = random.Random(size)
        names = {"".join(draw.choices("abcdef", k=14)) for _ in range(size)}
        df = spark.createDataFrame([("u", name) for name in names], "s string, name string")
        uses = similar._grams(df, ["s"]).groupBy("s", "gram").count()
        tokens = similar._tokens(df, uses.withColumnRenamed("count", "uses"), ["s"], 2)
        met = tokens.groupBy("s", "token").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
        seen[size] = met / tokens.count()
    assert seen[6000] < 1.5 * seen[1500] and seen[6000] < 20, seen


def test_similar_names_do_not_compare_all_pairs(spark):
    names = spark.createDataFrame(random_names(3, 50), "s string, name string")
    plan = similar_names(names, names, ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        similar_names(names, names, ["s"], 0)


def test_cities_that_are_spelled_almost_like_ports(spark, tmp_path):
    (tmp_path / "cities.csv").write_text(fixture.DEMOGRAPHICS.replace("New York;New York", "New Yorck;New York"))
    cities = read_source(spark, SourceSpec("c", str(tmp_path / "cities.csv"), "csv", separator=";"))
    feed = spark.createDataFrame(fixture.FEED, fixture.FEED_SCHEMA)
    ports = spark.createDataFrame(
        [("NYC", "NEW YORK", "NY"), ("LOS", "LOS ANGELES", "CA")], "port_code string, port_name string, port_state string"
    )
    found = {
        k: Counter(r["city"] for r in demographics_members(feed, ports, cities, k).collect()) for k in (0, 1)
    }
    assert found == {0: Counter({"Los Angeles": 2}), 1: Counter({"Los Angeles": 2, "New Yorck": 1})}


# SQL tables ------------------------------------------------------------------------


def specs(second="SELECT id, x * 2 AS y FROM made_first"):
    return [
        SqlTable("made_first", "SELECT monotonically_increasing_id() AS id, id AS x FROM range(5)", 2, "first"),
        SqlTable("made_second", second, 2, "second"),
    ]


def test_a_failing_statement_leaves_the_earlier_tables(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "sql")
    tables, metrics = build_sql_tables(spark, specs(), target)
    assert [m.rows for m in metrics] == [5, 5]
    before = {view: rows(df) for view, df in tables.items()}
    bad = ["SELECT id, 1 DIV (x - x) AS y FROM made_first", "SELECT id, x FROM made_first WHERE x > 99", "SELECT id FROM made_first"]
    for statement in bad:
        changed = specs(statement)
        changed[0] = SqlTable("made_first", "SELECT 7L AS id, 7L AS x", 2, "first")
        with pytest.raises(Exception):
            build_sql_tables(spark, changed, target)
        assert {view: rows(spark.table(view)) for view in before} == before
        assert {view: rows(df) for view, df in load_sql_tables(spark, specs(), target).items()} == before

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(sqltables, "publish", broken)
        with pytest.raises(OSError):
            build_sql_tables(spark, specs("SELECT id, x AS y FROM made_first"), target)
    assert {view: rows(spark.table(view)) for view in before} == before
    with pytest.raises(CheckFailed):
        load_sql_tables(spark, specs(), str(tmp_path / "nowhere"))


def test_a_statement_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    spark.udf.register("counted", F.udf(count, "bigint").asNondeterministic())
    build_sql_tables(spark, [SqlTable("made_once", "SELECT counted(id) AS id FROM range(9)", 1, "once")], str(tmp_path))
    assert seen.value == 9
