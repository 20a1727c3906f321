"""Projection, cast, filter, JSON, year and ratio operators."""

from conftest import rows
from pyspark.sql import functions as F

from titlematch.functions import NAME_LIST_SCHEMA, parse_json, ratio, to_long, year_string
from titlematch.operators.transforms import (
    add_ratio,
    add_year,
    cast_columns,
    filter_all,
    pluck,
    rename,
    repartition_by,
    subset,
)
from titlematch.plans.prepare import MOVIE_TYPES, movie_filters, prepare_movies


def test_subset_and_rename(spark):
    df = spark.createDataFrame([(1, "a", "b")], ["x", "y", "z"])
    assert subset(df, ["z", "x"]).columns == ["z", "x"]
    assert rename(df, {"y": "w", "missing": "q"}).columns == ["x", "w", "z"]


def test_to_long_legacy_semantics(spark):
    df = spark.createDataFrame([("12",), ("12.9",), ("abc",), (" 7 ",), (None,), ("",), ("-3.5",)], ["b"])
    assert [r[0] for r in df.select(to_long("b")).collect()] == [12, 12, None, 7, None, None, -3]


def test_cast_columns_null_on_failure(spark):
    df = spark.createDataFrame([("100", "2002-12-19", "[{'id': 1, 'name': 'A'}]"), ("n/a", "soon", "oops")], ["b", "d", "g"])
    out = cast_columns(df, {"b": "long", "d": "date", "g": NAME_LIST_SCHEMA})
    assert dict(out.dtypes) == {"b": "bigint", "d": "date", "g": "array<struct<id:int,name:string>>"}
    r = out.collect()
    assert r[0].b == 100 and str(r[0].d) == "2002-12-19" and r[0].g[0].name == "A"
    assert r[1].b is None and r[1].d is None and r[1].g is None


def test_json_lists(spark):
    data = [
        ("[{'id': 18, 'name': 'Drama'}, {'id': 10749, 'name': 'Romance'}]",),
        ('[{"id": 28, "name": "Action"}]',),
        ("[]",),
        (None,),
        ("nope",),
        ("[{'id': 1, 'name': 'x', 'extra': None}]",),
        ("{'id': 5, 'name': 'solo'}",),
        ("[{'id': 'abc', 'name': 'kept'}]",),
    ]
    df = spark.createDataFrame(data, ["g"])
    got = [r[0] for r in df.select(parse_json("g").getField("name")).collect()]
    assert got[0] == ["Drama", "Romance"]
    assert got[1] == ["Action"]
    assert got[2] == []
    assert got[3] is None and got[4] is None and got[5] is None
    assert got[6] == ["solo"]
    assert got[7] == ["kept"]


def test_pluck_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([("[{'id': 2, 'name': 'B'}, {'id': 1, 'name': 'A'}]",), (None,)], ["g"])
    out = pluck(df.withColumn("g", parse_json("g")), ["g"])
    assert [r.g for r in out.collect()] == [["B", "A"], None]


def test_filter_all_conjunction(spark):
    df = spark.createDataFrame([("a", 1, 1), ("", 1, 1), (None, 1, 1), ("  ", 1, 1), ("b", 0, 1), ("c", 1, None)], "title string, revenue long, budget long")
    out = filter_all(df, movie_filters())
    assert sorted(r.title for r in out.collect()) == ["  ", "a"]
    assert filter_all(df, []).count() == df.count()


def test_year_and_ratio(spark):
    df = spark.createDataFrame(
        [("2002-12-19", 10, 4), ("bad", 201, 200), (None, 1, 3), ("1999-01-01", 1, 0)], "d string, r long, b long"
    )
    out = add_ratio(add_year(df, "d", "y"), "r", "b", "q")
    assert "d" not in out.columns
    got = [(x.y, x.q) for x in out.collect()]
    # HALF_UP at two digits, on the double's decimal form (1.005 -> 1.01)
    assert got == [(2002, 2.5), (None, 1.01), (None, 0.33), (1999, None)]
    assert df.select(year_string("d")).first()[0] == "2002"
    assert df.select(ratio(F.lit(2), F.lit(3))).first()[0] == 0.67


def test_repartition_knob_is_off_by_default(spark):
    df = spark.range(10)
    assert repartition_by(df, "id") is df
    assert repartition_by(df, "id", enabled=True, num_partitions=3).rdd.getNumPartitions() == 3


def test_prepare_movies_schema_and_rows(spark):
    cols = ["title", "genres", "production_companies", "release_date", "vote_average", "budget", "revenue", "extra"]
    data = [
        ("Paper Moth", "[{'id': 3, 'name': 'Mystery'}]", "[{'name': 'Umi', 'id': 74}]", "1954-02-14", "7.5", "800000", "9000000", "x"),
        ("Zero Budget", "[]", "[]", "2000-01-01", "5", "0", "100", "x"),
        ("", "[]", "[]", "2000-01-01", "5", "10", "100", "x"),
        (" Spaced ", "[]", None, None, "5", "10", "15", "x"),
        ("Bad Money", "[]", "[]", "2000-01-01", "5", "n/a", "100", "x"),
    ]
    out = prepare_movies(spark.createDataFrame(data, cols))
    assert out.dtypes == [
        ("title", "string"),
        ("year", "string"),
        ("production_companies", "array<string>"),
        ("genres", "array<string>"),
        ("rating", "string"),
        ("revenue", "bigint"),
        ("budget", "bigint"),
        ("revenue_to_budget", "double"),
        ("cleaned_title", "string"),
    ]
    got = rows(out)
    assert got == [
        (" Spaced ", None, None, [], "5", 15, 10, 1.5, "spaced"),
        ("Paper Moth", "1954", ["Umi"], ["Mystery"], "7.5", 9000000, 800000, 11.25, "paper moth"),
    ]
    assert set(MOVIE_TYPES) == {"budget", "release_date", "revenue", "production_companies", "genres"}


def test_to_long_equals_the_legacy_cast(spark):
    from titlematch.functions.numeric import to_long

    values = [
        "1e3", "1E7", "12.9", "12.99999999999", "0.99999999999", ".5", "5.", "+5", "-5", "-.5", ".", "+", "-", "", " ", " 7 ", "\t8\n",
        "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "9223372036854775807.9",
        "1 2", "1.2.3", "0x1", "007", "--1", "1L", "NaN", "1,000", "12.x", "n/a", None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = {r.v: r.x for r in df.selectExpr("v", "CAST(v AS BIGINT) AS x").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert {r.v: r.x for r in df.select("v", to_long("v").alias("x")).collect()} == legacy
