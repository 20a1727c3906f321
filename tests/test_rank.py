"""Sort / top-k / explode / distinct operators."""

import pytest
from pyspark.sql import functions as F

from titlematch.operators.rank import distinct_values, explode_column, numbered, sort_by, top_exploded, top_k, top_k_wide


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [("a", 3.0, ["x", "y"]), ("b", None, ["z"]), ("c", 5.0, []), ("d", 3.0, None), ("e", 1.0, ["x"])],
        "t string, r double, c array<string>",
    )


def test_top_k_desc_nulls_last_and_ties(df):
    assert [r.t for r in top_k(df, "r", 10, tie_breakers=["t"]).collect()] == ["c", "a", "d", "e", "b"]
    assert [r.t for r in top_k(df, "r", 2, tie_breakers=["t"]).collect()] == ["c", "a"]
    assert top_k(df, "r", 0).count() == 0
    assert top_k(df, None, None).count() == 5
    assert [r.t for r in sort_by(df, "r", ascending=True, tie_breakers=["t"]).collect()] == ["b", "e", "a", "d", "c"]
    with pytest.raises(ValueError):
        top_k(df, "r", -1)


def test_top_k_plans_take_ordered(df):
    plan = top_k(df, "r", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_explode_drops_null_and_empty(df):
    out = explode_column(df, "c")
    assert "c" not in out.columns and "c_exploded" in out.columns
    assert sorted((r.t, r.c_exploded) for r in out.collect()) == [("a", "x"), ("a", "y"), ("b", "z"), ("e", "x")]


def test_top_exploded_counts_exploded_rows(df):
    out = top_exploded(df, "c", "r", 2, tie_breakers=["c_exploded"])
    assert [(r.t, r.c_exploded) for r in out.collect()] == [("a", "x"), ("a", "y")]


def test_distinct_values_first_seen(df):
    ex = explode_column(df, "c")
    first = distinct_values(ex, "c_exploded", [("r", "desc"), "c_exploded"])
    assert "rangepartitioning(r" not in first._jdf.queryExecution().executedPlan().toString()
    got = first.collect()
    assert [r.c_exploded for r in got] == ["x", "y", "z"]
    with pytest.raises(ValueError):
        distinct_values(ex, "c_exploded", [("t", "desc")])
    assert sorted(r[0] for r in distinct_values(ex, "c_exploded").collect()) == ["x", "y", "z"]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("n", [0, 1, 700, 2500, 9999])
def test_wide_top_k_is_top_k(spark, ascending, n):
    """Heavy ties, skewed values, NULL, NaN and infinite keys."""
    values = [None] * 300 + [float("nan")] * 100 + [float("inf"), float("-inf")] * 20 + [5.0] * 1500 + [1e300, -1e300, 0.0, -0.0]
    rows = [(i, v) for i, v in enumerate(values)] + [(10_000 + i, (i * 37 % 1000) ** 3 / 7.0) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, v double").repartition(5)
    got = top_k_wide(df, "v", n, ascending, ["id"]).collect()
    assert str(got) == str(top_k(df, "v", n, ascending, ["id"]).collect())


def test_wide_top_k_has_no_single_partition(spark):
    df = spark.range(200_000).select("id", (F.col("id") * 7919 % 200_000).alias("v")).repartition(8)
    plan = final_plan(top_k_wide(df, "v", 100_000, tie_breakers=["id"]))
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan
    assert top_k_wide(df, "v", 100_000, tie_breakers=["id"]).agg(F.min("v")).first()[0] == 100_000


def test_numbered(spark):
    df = spark.range(5000).select("id", (F.col("id") % 13).alias("k")).repartition(6)
    out = numbered(df, [F.col("k").desc(), F.col("id").asc()])
    want = sorted(((i, i % 13) for i in range(5000)), key=lambda t: (-t[1], t[0]))
    assert [(r.id, r.k, r.number) for r in out.orderBy("number").collect()] == [(i, k, n) for n, (i, k) in enumerate(want, 1)]
    assert "SinglePartition" not in final_plan(out)
    assert numbered(df.limit(0), [F.col("id").asc()]).collect() == []
