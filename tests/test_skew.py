"""Skew.  A hot title (a third of all movie rows, most articles) under forced AQE
skew splitting gives the same multiset as the specification form."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_match import ARTICLE_SCHEMA, MOVIE_SCHEMA, article, movie

from titlematch.operators.match import heavy_keys, tiered_match, tiered_match_except

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    # split even where the split costs an extra exchange (README, "At 1000x")
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_title(spark, skew_conf):
    movies = []
    for i in range(300):
        movies.append(movie(f"Other {i}", str(1990 + i % 20), float(i % 7)))
    for i in range(150):  # a third of all rows: one title, duplicates and distinct years
        movies.append(movie("Hot", str(2000 + i % 3), 1.0))
    articles = [article("hot", "2000", "film", f"hot-f-{i}") for i in range(20)]
    articles += [article("hot", "", "", f"hot-p-{i}") for i in range(30)]
    articles += [article(f"other {i}", "", "film", f"o-{i}") for i in range(0, 300, 3)]
    articles += [article(f"other {i}", "", "", f"p-{i}") for i in range(0, 300, 2)]
    m = spark.createDataFrame(movies, MOVIE_SCHEMA).repartition(6)
    a = spark.createDataFrame(articles, ARTICLE_SCHEMA).repartition(6)
    fast = tiered_match(m, a)
    def key(r):
        return tuple(tuple(x) if isinstance(x, list) else x for x in r)

    got = Counter(key(r) for r in fast.collect())
    plan = fast._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Final Plan ==") + 4000].splitlines() if "Final Plan ==" in plan else plan.splitlines()
    joins = [line for line in final if "Join" in line]
    assert "LeftOuter" in joins[0] and "skew=true" in joins[0], joins  # the final join itself
    want = Counter(key(r) for r in tiered_match_except(m, a).collect())
    assert got == want
    hot = Counter((r[1], r[8] is not None and r[8].startswith("hot-f")) for r in got.elements() if r[0] == "Hot")
    # 50 copies of year 2000 keep multiplicity and take all 20 film articles;
    # 2001 and 2002 collapse to one row each and take the 30 plain articles.
    assert hot[("2000", True)] == 50 * 20
    assert hot[("2001", False)] == 30 and hot[("2002", False)] == 30


def test_unmatched_movies_spread(spark):
    """80 % of the movies match nothing; without AQE no partition of the final
    join holds much more than its share."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        m = spark.createDataFrame([movie(f"Title {i}", str(1950 + i % 60), float(i % 9)) for i in range(4000)], MOVIE_SCHEMA)
        a = spark.createDataFrame([article(f"title {i}", "", "film") for i in range(0, 4000, 5)], ARTICLE_SCHEMA)
        sizes = [r["count"] for r in tiered_match(m, a).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 3 * 4000 / 16


def hot_articles(spark, workdir, hot=3000):
    """One title holds most articles, in every tier; some movies of it match
    nothing of their year, and some repeat."""
    a = [article("hot", str(1990 + i % 30), "film", f"hot-f-{i}") for i in range(hot // 2)]
    a += [article("hot", "", "film" if i % 2 else "", f"hot-p-{i}") for i in range(hot // 2)]
    a += [article(f"other {i}", "", "film", f"o-{i}") for i in range(600)] + [article(None, "", "film", "none")]
    m = [movie("Hot", str(1985 + i % 40), 1.0 + i % 3) for i in range(60)] + [movie("Hot", None, 2.0)] * 2
    m += [movie(f"Other {i}", "2000", 1.0) for i in range(0, 900, 3)]
    spark.createDataFrame(m, MOVIE_SCHEMA).repartition(4).write.parquet(f"{workdir}/m")
    spark.createDataFrame(a, ARTICLE_SCHEMA).repartition(4).write.parquet(f"{workdir}/a")
    return spark.read.parquet(f"{workdir}/m"), spark.read.parquet(f"{workdir}/a")


@pytest.fixture()
def plain_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def flat_rows(df):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect())


def test_hot_title_by_its_articles(spark, plain_conf, workdir):
    """Without AQE, and with most articles under one title, no task of the final
    join has three times the mean."""
    m, a = hot_articles(spark, workdir)
    heavy = heavy_keys(a)
    assert [(r.cleaned_title, r.rows) for r in heavy.collect()] == [("hot", 3000)]
    out = tiered_match(m, a, heavy=heavy)
    assert flat_rows(out) == flat_rows(tiered_match_except(m, a))
    sizes = [r["count"] for r in out.filter("url LIKE '%hot-%'").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 16, sizes
    one = [r["count"] for r in tiered_match(m, a).filter("url LIKE '%hot-%'").groupBy(F.spark_partition_id()).count().collect()]
    assert max(one) > max(sizes)


def test_no_heavy_title(spark, workdir):
    m, a = hot_articles(spark, workdir, hot=20)
    assert heavy_keys(a.filter("cleaned_title <> 'hot'"), partitions=4).count() == 0
    assert heavy_keys(a.limit(0)).count() == 0
    assert flat_rows(tiered_match(m, a, heavy=heavy_keys(a.limit(0)))) == flat_rows(tiered_match_except(m, a))


@pytest.mark.parametrize("hot", [20, 3000])
def test_partitioned_match_moves_no_article(spark, plain_conf, workdir, hot):
    from titlematch.plans.job import partitioned_match, unbucketed

    m, a = hot_articles(spark, workdir, hot)
    root = f"{workdir}/job-{uuid.uuid4().hex}"
    out = partitioned_match(m, a, root)
    try:
        assert flat_rows(out) == flat_rows(tiered_match_except(m, a))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        unbucketed(spark, root)
    # an article's content (its abstract) is in the output of no exchange
    nodes = plan.split("\n")
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    for i, line in enumerate(nodes):
        if "Exchange" in line and "Broadcast" not in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for other in nodes[i + 1 :]:
                if len(other) - len(other.lstrip(" :+-")) <= depth:
                    break
                below.append(other)
            assert not any("abstract" in x for x in below), line
