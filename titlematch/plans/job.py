"""The batch job: prepare both sources, match, write the top rows.

Cluster behaviour:

* Both prepared tables are written once as Parquet under the session's
  ``spark.checkpoint.dir`` (a shared folder on a cluster).  That cuts the
  lineage - a lost executor re-reads Parquet instead of re-parsing XML - and
  the match's two passes over each side read only the columns they need.
* Row counts are those of the committed files, read from their footers.  A count
  taken while the rows pass (an ``Observation``) would count a task's rows again
  when it is run again, and none at all where the plan is emptied.
* Of the articles only those whose title some movie has are staged with their
  content, whatever the sizes: every tier keys on the title, so no other article
  can match.  The others are staged as their title alone, for the count.  The
  joins carry no hint; AQE broadcasts a side that turns out small, and coalesces
  or splits partitions otherwise.
* Errors are logged and re-raised; staged tables are removed either way.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlematch import columns as C
from titlematch.operators.match import heavy_keys, tiered_match, tiered_match_colocated
from titlematch.operators.rank import top_k
from titlematch.plans.prepare import prepare_articles, prepare_movies
from titlematch.sinks.write import ParquetTarget, TableTarget, write_table
from titlematch.sources.delimited import read_movies
from titlematch.sources.jdbc import JdbcTarget
from titlematch.sources.xml import read_articles
from titlematch.staging import new_folder, scope

log = logging.getLogger(__name__)

# Rows written by the job, and their order.
RESULT_ROWS = 1000
RESULT_ORDER = C.REVENUE_TO_BUDGET
RESULT_TIE_BREAKERS = (
    C.TITLE,
    C.YEAR,
    C.URL,
    C.RATING,
    C.REVENUE,
    C.BUDGET,
    C.ABSTRACT,
    C.GENRES,
    C.PRODUCTION_COMPANIES,
)


@dataclass
class JobResult:
    movies: int
    articles: int
    stage_dir: str


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def candidates(articles: DataFrame, movies: DataFrame) -> DataFrame:
    """Articles whose title some movie has; no other article can match."""
    titles = movies.select(F.col(C.CLEANED_TITLE).alias("__t")).distinct()
    return articles.join(titles, F.col(C.CLEANED_TITLE) == F.col("__t"), "left_semi")


def staged_sources(movies: DataFrame, articles: DataFrame, root: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Both prepared tables staged under ``root``, and how many rows each had.

    Every prepared article is a staged row, so the committed files hold the
    count; only candidates keep more than their title, and only they are
    returned."""
    movies = stage(movies, f"{root}/movies")
    titles = movies.select(F.col(C.CLEANED_TITLE).alias("__t")).distinct()
    marked = articles.join(titles, F.col(C.CLEANED_TITLE) == F.col("__t"), "left")
    wanted = F.col("__t").isNotNull()
    others = [F.when(wanted, F.col(c)).alias(c) for c in articles.columns if c != C.CLEANED_TITLE]
    rows = stage(marked.select(C.CLEANED_TITLE, *others, wanted.alias("__wanted")), f"{root}/articles")
    return movies, rows.filter("__wanted").select(*articles.columns), movies.count(), rows.count()


COPARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def _table_name(path: str) -> str:
    folder, name = path.rsplit("/", 1)
    return f"titlematch_{folder.rsplit('-', 1)[-1]}_{name}".replace("-", "_")


def bucketed(df: DataFrame, path: str, columns: list[str], buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``columns``, at ``path``.  The table's
    name goes with the session's catalog entry; see ``unbucketed``."""
    name = _table_name(path)
    rows = df.repartition(buckets, *columns)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def partitioned_match(movies: DataFrame, articles: DataFrame, root: str, buckets: int | None = None) -> DataFrame:
    """The match of staged tables laid out by title once.

    Both sides are written as tables bucketed by title, so that the tiers of a
    title, the collapse of duplicates and the final join all use one layout, and
    no exchange moves an article after that.  Titles with more articles than a
    mean bucket are laid out by title and salt in tables of their own.  The result
    must be read with ``COPARTITION`` false, as ``run`` does."""
    spark = movies.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(articles, partitions=n)
    few = F.broadcast(heavy.select(C.CLEANED_TITLE))
    title = [C.CLEANED_TITLE]
    cold = [bucketed(df.join(few, C.CLEANED_TITLE, "left_anti"), f"{root}/{name}-by-title", title, n) for df, name in ((movies, "m"), (articles, "a"))]
    out = tiered_match_colocated(*cold)
    if heavy.isEmpty():
        return out
    salts = F.broadcast(heavy.select(C.CLEANED_TITLE, "salts"))
    dealt = articles.join(salts, C.CLEANED_TITLE).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), "salts"))
    hot = bucketed(dealt, f"{root}/a-by-salt", [C.CLEANED_TITLE, "__salt"], n)
    return out.union(tiered_match_colocated(movies.join(salts, C.CLEANED_TITLE), hot, salted_buckets=n))


def unbucketed(spark: SparkSession, root: str) -> None:
    """Takes the tables under ``root`` out of the session's catalog."""
    for name in ("m-by-title", "a-by-title", "a-by-salt"):
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{root}/{name}')}")


def ranked(df: DataFrame, rows: int | None = RESULT_ROWS) -> DataFrame:
    """The job's result rows of a match: the top ``rows`` by revenue/budget."""
    return top_k(df, RESULT_ORDER, rows, tie_breakers=RESULT_TIE_BREAKERS)


def run(
    spark: SparkSession,
    movies_path: str,
    articles_path: str,
    target: ParquetTarget | TableTarget | JdbcTarget | str,
    table: str | None = "movies",
    rows: int | None = RESULT_ROWS,
    mode: str = "overwrite",
    splittable_xml: bool = True,
    keep_stage: bool = False,
    partitioned: bool = False,
    lexed_xml: bool = False,
) -> JobResult:
    """Read, prepare, match and write the top ``rows`` by revenue/budget.

    The staged tables are removed in the end, also after a failure, unless
    ``keep_stage``.  Titles with very many articles are found on the staged table
    and split.  ``partitioned`` lays the staged tables out by title first
    (``partitioned_match``), which pays when articles are large and matched by a
    shuffle anyway.
    """
    root = None
    try:
        with scope(spark) as owned:
            root = new_folder(spark, "job")
            if keep_stage:
                owned.clear()
            log.info("preparing movies and articles under %s", root)
            prepared = prepare_movies(read_movies(spark, movies_path))
            raw = read_articles(spark, articles_path, splittable=splittable_xml, lexed=lexed_xml)
            movies, articles, n_movies, n_articles = staged_sources(prepared, prepare_articles(raw), root)
            log.info("%d rows in movie table, %d rows in article table", n_movies, n_articles)
            if partitioned:
                old = spark.conf.get(COPARTITION, "true")
                spark.conf.set(COPARTITION, "false")
                try:
                    write_table(ranked(partitioned_match(movies, articles, root), rows), target, table=table, mode=mode)
                finally:
                    spark.conf.set(COPARTITION, old)
                    unbucketed(spark, root)
            else:
                heavy = heavy_keys(articles)
                match = tiered_match(movies, articles, heavy=None if heavy.isEmpty() else heavy)
                write_table(ranked(match, rows), target, table=table, mode=mode)
            return JobResult(n_movies, n_articles, root)
    except Exception:
        log.exception("job failed")
        raise
