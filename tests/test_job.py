"""End-to-end job on test-written files; sinks; SQL helpers; JDBC settings."""

import os
from collections import Counter

import pytest
from fixtures import ARTICLE_URLS, CASES, DROPPED_LINES, GOLDEN, MOVIES, WANTED_URLS, results, write_articles, write_movies

from titlematch.plans import run, run_sql, table_schema
from titlematch.plans.prepare import prepare_articles, prepare_movies
from titlematch.operators.match import tiered_match, tiered_match_except
from titlematch.operators.rank import explode_column, top_exploded
from titlematch.sinks import ParquetTarget, write_table
from titlematch.sources import JdbcTarget, read_articles, read_movies


def test_job_golden(spark, workdir):
    out = os.path.join(workdir, "result")
    res = run(spark, write_movies(workdir), write_articles(workdir), ParquetTarget(out))
    assert (res.movies, res.articles) == (MOVIES, len(ARTICLE_URLS))
    assert not os.path.exists(res.stage_dir.replace("file:", ""))
    assert results(spark.read.parquet(out)) == GOLDEN
    # the cases' own remarks say the same
    assert sum(GOLDEN.values()) == sum(len(urls) for _, urls in CASES)
    assert sorted(str(k[3]) for k in GOLDEN.elements()) == sorted(str(u) for _, urls in CASES for u in urls)
    assert set(spark.read.parquet(out).columns) == {
        "title", "year", "production_companies", "genres", "rating", "revenue", "budget", "revenue_to_budget",
        "url", "abstract",
    }


def test_job_forms_agree_and_notebook_queries(spark, workdir):
    m = prepare_movies(read_movies(spark, write_movies(workdir)))
    a = prepare_articles(read_articles(spark, write_articles(workdir)))
    fast = sorted(map(tuple, tiered_match(m, a).collect()), key=str)
    slow = sorted(map(tuple, tiered_match_except(m, a).collect()), key=str)
    assert fast == slow
    res = tiered_match(m, a)
    ex = explode_column(res, "production_companies")
    # without companies there is no exploded row
    assert "Vesper & Co" not in {r.title for r in ex.collect()}
    top = top_exploded(res, "production_companies", "revenue_to_budget", 3, tie_breakers=["production_companies_exploded"])
    assert [r.production_companies_exploded for r in top.collect()] == ["Arbor & Sons", "Ninefold", "Kelp"]


def test_job_reraises(spark, workdir):
    root = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    with pytest.raises(Exception):
        run(spark, write_movies(workdir), os.path.join(workdir, "missing.xml"), os.path.join(workdir, "o"))
    # nothing staged is left behind
    assert not os.path.isdir(root) or not [d for d in os.listdir(root) if d.startswith("titlematch-job-")]


def test_write_table_modes_and_top_rows(spark, workdir):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(20)], "id int, r double")
    p = os.path.join(workdir, "t")
    write_table(df, p, order_by="r", rows=3, tie_breakers=["id"])
    assert [x.id for x in spark.read.parquet(p).orderBy("id").collect()] == [4, 9, 14]
    write_table(df, p, mode="append", order_by="r", rows=2, tie_breakers=["id"])
    assert spark.read.parquet(p).count() == 5
    write_table(df, p, rows=0)
    assert spark.read.parquet(p).count() == 0
    write_table(df, ParquetTarget(os.path.join(workdir, "part"), ("r",)))
    assert spark.read.parquet(os.path.join(workdir, "part")).filter("r = 1.0").count() == 4
    with pytest.raises(ValueError):
        write_table(df, p, mode="upsert")
    with pytest.raises(ValueError):
        write_table(df, JdbcTarget("jdbc:none://x"))


def test_jdbc_target_from_env():
    env = {"PG_HOST": "db", "PG_PORT": "5432", "PG_DATABASE": "m", "PG_USER": "u", "PG_PASSWORD": "p"}
    t = JdbcTarget.from_env("PG_", env)
    assert t.url == "jdbc:postgresql://db:5432/m"
    assert t.properties == {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    with pytest.raises(KeyError):
        JdbcTarget.from_env("PG_", {k: v for k, v in env.items() if k != "PG_USER"})


def test_run_sql_and_schema(spark):
    df = spark.createDataFrame([("a", 1.0, ["x"])], "title string, r double, c array<string>")
    out = run_sql(spark, "SELECT title, r * 2 AS r2 FROM {movies} WHERE r > 0", movies=df)
    assert out.collect()[0].r2 == 2.0
    braces = run_sql(spark, """SELECT '{"a": 1}' AS j, '{movie}' AS m, title FROM {movies}""", movies=df).first()
    assert tuple(braces) == ('{"a": 1}', "{movie}", "a")
    sch = table_schema(df).collect()
    assert [(r.column_name, r.data_type) for r in sch] == [("title", "string"), ("r", "double"), ("c", "array<string>")]
    assert [r.column_name for r in table_schema(df).filter("column_name = 'r'").collect()] == ["r"]


def test_cli_and_stage_cleanup(spark, workdir):
    from titlematch.__main__ import main

    out = os.path.join(workdir, "cli_out")
    assert main([write_movies(workdir), write_articles(workdir), "--parquet", out, "--rows", "3"]) == 0
    assert spark.read.parquet(out).count() == 3
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert not [d for d in os.listdir(root) if d.startswith("titlematch-job-")]
    res = run(spark, write_movies(workdir), write_articles(workdir), os.path.join(workdir, "o2"), keep_stage=True)
    assert os.path.isdir(res.stage_dir.replace("file:", "") + "/movies")


@pytest.mark.parametrize("threshold", ["10485760", "100", "1MB", "-1"])
def test_job_stages_the_same_at_any_threshold(spark, workdir, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = os.path.join(workdir, "result_nb")
        res = run(spark, write_movies(workdir), write_articles(workdir), ParquetTarget(out), keep_stage=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert (res.movies, res.articles) == (MOVIES, len(ARTICLE_URLS))
    staged = {r.url.rsplit("/", 1)[-1] for r in spark.read.parquet(res.stage_dir + "/articles").filter("url IS NOT NULL").collect()}
    assert staged == set(WANTED_URLS)
    assert results(spark.read.parquet(out)) == GOLDEN


def test_one_machines_folder_is_refused_on_a_cluster():
    from titlematch.staging import shared_dir

    class Session:
        class conf:  # noqa: N801
            values = {"spark.checkpoint.dir": "file:/tmp/x", "spark.master": "spark://host:7077"}

            @classmethod
            def get(cls, name, default=None):
                return cls.values.get(name, default)

    with pytest.raises(ValueError, match="one machine"):
        shared_dir(Session)
    Session.conf.values["spark.checkpoint.dir"] = "hdfs://store/x"
    assert shared_dir(Session) == "hdfs://store/x"


def test_write_catalog_table(spark):
    from titlematch.sinks import TableTarget

    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, r double")
    write_table(df, TableTarget("tm_result"), order_by="r", rows=4, tie_breakers=["id"])
    assert [r.id for r in spark.table("tm_result").orderBy("id").collect()] == [6, 7, 8, 9]
    write_table(df, TableTarget("tm_result"), mode="append", order_by="r", rows=1)
    assert spark.table("tm_result").count() == 5
    spark.sql("DROP TABLE tm_result")


def test_read_table_needs_all_bounds(spark):
    from titlematch.sources import read_table

    with pytest.raises(ValueError):
        read_table(spark, JdbcTarget("jdbc:none://x"), "t", partition_column="id", lower_bound=0)


@pytest.mark.parametrize("lines", [[], DROPPED_LINES])
def test_job_without_movies(spark, workdir, lines):
    """A header alone, or no movie that passes the filters: an empty result, and
    the true number of articles."""
    movies = write_movies(workdir, lines)
    out = os.path.join(workdir, "result_none")
    res = run(spark, movies, write_articles(workdir), ParquetTarget(out))
    assert (res.movies, res.articles) == (0, len(ARTICLE_URLS))
    assert spark.read.parquet(out).count() == 0


def test_job_without_articles(spark, workdir):
    out = os.path.join(workdir, "result_no_articles")
    res = run(spark, write_movies(workdir), write_articles(workdir, []), ParquetTarget(out))
    assert res.articles == 0
    assert results(spark.read.parquet(out)) == Counter((*k[:3], None) for k in {k[:3]: k for k in GOLDEN})  # duplicates collapse


def test_counts_hold_when_tasks_run_again(spark, workdir):
    """Every input task fails once after passing its rows on; the counts are
    those of the committed files."""
    from titlematch.plans.job import staged_sources

    m = prepare_movies(read_movies(spark, write_movies(workdir)))
    a = prepare_articles(read_articles(spark, write_articles(workdir)))
    marks = os.path.join(workdir, "failed")
    os.mkdir(marks)

    def once(batches):
        from pyspark import TaskContext

        yield from batches
        mark = os.path.join(marks, str(TaskContext.get().partitionId()))
        if TaskContext.get().attemptNumber() == 0 and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost")

    spark_conf = spark.sparkContext.getConf().get("spark.master")
    if "," not in spark_conf:
        pytest.skip("tasks are not run again on this master")
    _, _, movies, articles = staged_sources(m, a.mapInArrow(once, a.schema), os.path.join(workdir, "stage"))
    assert (movies, articles) == (MOVIES, len(ARTICLE_URLS)) and os.listdir(marks)


def test_failed_overwrite_keeps_the_old_result(spark, workdir):
    from pyspark.sql import functions as F

    from titlematch.sinks import TableTarget

    good = spark.range(10).select(F.col("id").cast("int").alias("id"))
    bad = spark.range(10).select(F.when(F.col("id") > 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("id"))
    path = os.path.join(workdir, "kept")
    for target, read in ((ParquetTarget(path), lambda: spark.read.parquet(path)), (TableTarget("tm_kept"), lambda: spark.table("tm_kept"))):
        write_table(good, target)
        with pytest.raises(Exception, match="lost"):
            write_table(bad, target)
        assert sorted(r.id for r in read().collect()) == list(range(10))
        write_table(read().filter("id < 3"), target)  # what is read may be overwritten
        assert sorted(r.id for r in read().collect()) == [0, 1, 2]
    assert os.listdir(workdir) == ["kept"]
    spark.sql("DROP TABLE tm_kept")


@pytest.mark.parametrize("options", [{"partitioned": True}, {"lexed_xml": True}])
def test_job_options_give_the_same(spark, workdir, options):
    out = os.path.join(workdir, "result")
    res = run(spark, write_movies(workdir), write_articles(workdir), ParquetTarget(out), **options)
    assert results(spark.read.parquet(out)) == GOLDEN and not os.path.exists(res.stage_dir.replace("file:", ""))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("titlematch_")]
