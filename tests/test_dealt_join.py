"""Joins dealt by pairs: the same rows as a plain join, and no task gives out most of them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_match import ARTICLE_SCHEMA, MOVIE_SCHEMA, article, movie

from titlematch.operators import match
from titlematch.operators.match import deal_pairs, dealt_join, except_matched, tiered_match_except
from titlematch.plans import catalogue as cat


def flat_rows(df):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect())


def sides(spark):
    """Hot on the left, on the right, on both; on one side only; NULL and repeated rows."""
    left = [("both", i % 50) for i in range(400)] + [("many left", i) for i in range(900)] + [("many right", 1)] * 2
    left += [(None, i) for i in range(500)] + [("no right", i) for i in range(700)] + [(f"k{i}", i) for i in range(60)]
    right = [("both", i % 70) for i in range(300)] + [("many left", 5)] + [("many right", i) for i in range(1500)]
    right += [(None, i) for i in range(300)] + [("no left", i) for i in range(800)] + [(f"k{i}", -i) for i in range(0, 60, 2)]
    return spark.createDataFrame(left, "k string, x int").repartition(4), spark.createDataFrame(right, "k string, y int").repartition(3)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("pairs_per_task", [1_000_000, 20_000, 300])
def test_dealt_join_equals_plain_join(spark, how, pairs_per_task):
    left, right = sides(spark)
    dealing = deal_pairs(left, right, ["k"], pairs_per_task)
    assert (dealing.tasks == 1) == (pairs_per_task == 1_000_000)
    out = dealt_join(left, right, ["k"], how, dealing)
    want = left.join(right, ["k"], how)
    assert out.columns == want.columns and flat_rows(out) == flat_rows(want)
    given = dealt_join(left, right, ["k"], how, dealing, F.xxhash64("k", "x"))
    assert flat_rows(given) == flat_rows(want)


def test_dealt_join_on_two_keys_and_empty_sides(spark):
    left, right = (d.withColumn("n", F.when(F.col(c) % 7 != 0, F.col(c) % 3)) for d, c in zip(sides(spark), "xy", strict=True))
    for lt, rt in ((left, right), (left, right.limit(0)), (left.limit(0), right)):
        dealing = deal_pairs(lt, rt, ["k", "n"], 500)
        for how in ("inner", "left"):
            assert flat_rows(dealt_join(lt, rt, ["k", "n"], how, dealing)) == flat_rows(lt.join(rt, ["k", "n"], how))


def test_a_bound_of_the_left_rows_is_enough(spark):
    left, right = sides(spark)
    dealing = deal_pairs(left, right, ["k"], 1000)
    fewer = left.distinct().filter("x % 3 = 0")
    assert flat_rows(dealt_join(fewer, right, ["k"], "left", dealing, F.xxhash64("k", "x"))) == flat_rows(fewer.join(right, ["k"], "left"))


def test_few_heavy_keys_at_most_four_a_task(spark):
    left, right = sides(spark)
    dealing = deal_pairs(left, right, ["k"], 2000)
    assert 0 < len(dealing.heavy) <= 4 * dealing.tasks
    assert all(a >= 1 and b >= 1 for *_, a, b in dealing.heavy)
    assert deal_pairs(left.limit(0), right.limit(0), ["k"]).tasks == 1


@pytest.mark.parametrize("name", ["join_title", "left_join_title"])
def test_one_title_of_many_movies_and_articles(spark, workdir, name):
    """24 million pairs of one title: no partition gives out a third of them."""
    part = spark.range(12_000).select(
        F.col("id").alias("p_partkey"), F.lit("blue rod").alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"),
        F.lit(5).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    part.repartition(4).write.parquet(f"{workdir}/part.parquet")
    out = cat.QUERIES[name](spark, workdir)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    m, a = cat.both_prepared(spark, workdir)
    right = a.filter("year = '' AND type = 'film'" if name == "join_title" else "year = '' AND type = ''").count()
    assert sum(sizes) == m.count() * right
    assert max(sizes) < sum(sizes) / 3, sizes


def films(spark):
    m = [movie("Hot", str(1990 + i % 9), float(i % 11)) for i in range(200)] + [movie("Hot", "1990", 0.0)] * 5
    m += [movie(f"T {i}", str(1990 + i % 3), 1.0) for i in range(30)] * 2 + [movie("None", None)] * 3 + [movie("Hot", None, 2.0)] * 2
    a = [article("hot", "1990", "film", f"y{i}") for i in range(40)] + [article("hot", "", "film", f"f{i}") for i in range(90)]
    a += [article(f"t {i}", "", "film" if i % 2 else "") for i in range(0, 30, 3)] + [article(None, "", "", "none"), article("t 3", None, "film")]
    return spark.createDataFrame(m, MOVIE_SCHEMA), spark.createDataFrame(a, ARTICLE_SCHEMA)


def test_except_of_matched_rows(spark):
    m, a = films(spark)
    e = a.filter("year = '' AND type = 'film'")
    hit = m.join(e.drop("year"), ["cleaned_title"], "inner").select(*m.columns)
    assert flat_rows(except_matched(m, e, ["cleaned_title"])) == flat_rows(m.subtract(hit))


def test_tiers_dealt_and_except_without_pairs(spark, monkeypatch):
    m, a = films(spark)
    plain = flat_rows(tiered_match_except(m, a))
    monkeypatch.setattr(match.deal_pairs, "__defaults__", (100,))
    out = tiered_match_except(m, a)
    assert flat_rows(out) == plain
    assert flat_rows(match.tiered_match(m, a)) == plain
    # what EXCEPT takes away is named by keys: no movie columns on that side, and no join under it but such ones
    anti = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "LeftAnti" in line]
    assert anti and not any("revenue" in line or "genres" in line for line in anti)
