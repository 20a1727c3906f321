"""Query catalogue over the driver tables, with an equivalent DuckDB SQL each.

Every query reads whole tables (``part``, ``pages``, ``events``, ``orders``)
through the shared views of :mod:`titlematch.plans.views` and runs the
library's operators on them.  Array columns are flattened with
``array_join(.., '|')`` at the very end so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch import columns as C
from titlematch.functions.json import parse_json
from titlematch.functions.text import ARTICLE_URL_PATTERN, clean_title
from titlematch.operators.match import (
    FILM_TIERS,
    deal_pairs,
    dealt_join,
    except_matched,
    heavy_keys,
    tiered_match,
    tiered_match_except,
)
from titlematch.operators.rank import distinct_values, explode_column, numbered, top_exploded, top_k, top_k_wide
from titlematch.operators.transforms import add_year, cast_columns, filter_all, pluck, rename, subset
from titlematch.operators.urls import parse_article_url
from titlematch.plans.job import RESULT_TIE_BREAKERS, candidates, ranked, staged_sources
from titlematch.plans.prepare import (
    JSON_LIST_COLUMNS,
    MOVIE_RENAMES,
    MOVIE_TYPES,
    movie_filters,
    prepare_articles,
    prepare_movies,
)
from titlematch.plans.sql import run_sql
from titlematch.plans.views import ARTICLE_VIEW, MOVIE_VIEW, for_duckdb, for_spark
from titlematch.sources.delimited import APOSTROPHE_ESCAPE, read_delimited
from titlematch.sources.xml import ARTICLE_SCHEMA_PRUNED, read_articles, xml_records
from titlematch.staging import new_folder, scope, staged

Query = Callable[[SparkSession, str], DataFrame]

TOP_K_ROWS = 1000
TOP_EXPLODED_ROWS = 10


# ----------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def movie_view(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    part = part if part is not None else _table(spark, sf_dir, "part")
    return spark.sql(for_spark(MOVIE_VIEW), part=part)


def article_view(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    part = part if part is not None else _table(spark, sf_dir, "part")
    return spark.sql(for_spark(ARTICLE_VIEW), part=part)


def movies(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    return prepare_movies(movie_view(spark, sf_dir, part))


def movie_view_with_copies(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    """The movie view plus a second copy of every row; in the copy the
    release date is unreadable when ``vote_average`` is 0-2.  That gives
    exact duplicates (tier-1 rows keep them, the rest collapse) and NULL-year
    variants (never tier 1) over the whole table."""
    mv = movie_view(spark, sf_dir, part)
    unknown = F.when(F.col(C.VOTE_AVERAGE).isin("0", "1", "2"), F.lit("unknown")).otherwise(F.col(C.RELEASE_DATE))
    return mv.unionByName(mv.withColumn(C.RELEASE_DATE, unknown))


def articles(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    return prepare_articles(article_view(spark, sf_dir, part))


def both_prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prepared movies and articles over one read of ``part``."""
    part = _table(spark, sf_dir, "part")
    return movies(spark, sf_dir, part), articles(spark, sf_dir, part)


def flat(df: DataFrame, sep: str = "|") -> DataFrame:
    """array<string> columns -> ``array_join`` strings (cross-engine comparable)."""
    return df.withColumns(
        {f.name: F.array_join(f.name, sep) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    )


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered_match(*both_prepared(spark, sf_dir))


OUTPUT_TIE_BREAKERS = [
    C.TITLE,
    C.YEAR,
    C.URL,
    C.RATING,
    C.REVENUE,
    C.BUDGET,
    C.ABSTRACT,
    C.GENRES,
    C.PRODUCTION_COMPANIES,
]


# ---------------------------------------------------------------- queries


def q_url_parse(spark, sf):
    return parse_article_url(article_view(spark, sf)).select(C.TITLE, C.URL, C.CLEANED_TITLE, C.YEAR, C.TYPE)


def q_url_parse_pages(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return parse_article_url(pages).select("page_id", C.URL, C.CLEANED_TITLE, C.YEAR, C.TYPE)


def q_clean_title(spark, sf):
    return movie_view(spark, sf).select("id", C.TITLE, clean_title(C.TITLE).alias(C.CLEANED_TITLE))


def q_project_rename(spark, sf):
    df = subset(movie_view(spark, sf), ["id", *C.MOVIE_KEY_COLUMNS])
    df = rename(df, MOVIE_RENAMES).drop(C.RELEASE_DATE)
    return df


def q_cast_types(spark, sf):
    df = subset(movie_view(spark, sf), ["id", *C.MOVIE_KEY_COLUMNS])
    df = cast_columns(df, {k: v for k, v in MOVIE_TYPES.items() if k not in JSON_LIST_COLUMNS})
    df = add_year(df, C.RELEASE_DATE, C.YEAR).withColumn(C.YEAR, F.col(C.YEAR).cast("string"))
    return df.select("id", C.BUDGET, C.REVENUE, C.YEAR)


def q_filter_set(spark, sf):
    df = subset(movie_view(spark, sf), ["id", *C.MOVIE_KEY_COLUMNS])
    df = cast_columns(df, {C.BUDGET: "long", C.REVENUE: "long"})
    return filter_all(df, movie_filters()).select("id", C.TITLE, C.BUDGET, C.REVENUE)


def q_json_names(spark, sf):
    df = subset(movie_view(spark, sf), ["id", *JSON_LIST_COLUMNS])
    df = cast_columns(df, {c: MOVIE_TYPES[c] for c in JSON_LIST_COLUMNS})
    return flat(pluck(df, JSON_LIST_COLUMNS, "name"))


def q_json_props(spark, sf):
    ev = _table(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", parse_json("props", "struct<k:int>").getField("k").alias("k"))


def q_ratio(spark, sf):
    return movies(spark, sf).select(C.TITLE, C.YEAR, C.REVENUE, C.BUDGET, C.REVENUE_TO_BUDGET)


def q_year_of_date(spark, sf):
    o = _table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    o = add_year(o, "o_orderdate", "o_year").withColumn("o_year", F.col("o_year").cast("string"))
    return o.select("o_orderkey", "o_year")


def q_movies_prepared(spark, sf):
    return flat(movies(spark, sf))


def q_articles_prepared(spark, sf):
    return articles(spark, sf)


def _tier_join(spark, sf, tier_no: int, how: str):
    t = FILM_TIERS[tier_no - 1]
    m, a = both_prepared(spark, sf)
    a = a.filter(F.expr(t.right_filter))
    if C.YEAR not in t.keys:
        a = a.drop(C.YEAR)
    a = staged(a, "tier-articles")  # read by the counts of pairs, too; their URLs are parsed once
    # lists become text once a movie, not once a pair
    out = dealt_join(flat(m), a, t.keys, how, deal_pairs(m, a, t.keys))
    return out.select(*C.OUTPUT_COLUMNS)


def q_join_title_year(spark, sf):
    return _tier_join(spark, sf, 1, "inner")


def q_join_title(spark, sf):
    return _tier_join(spark, sf, 2, "inner")


def q_left_join_title(spark, sf):
    return _tier_join(spark, sf, 3, "left")


def q_except_matched(spark, sf):
    m, a = both_prepared(spark, sf)
    t = FILM_TIERS[0]
    a = a.filter(F.expr(t.right_filter))
    return flat(except_matched(m, a, t.keys))


def q_union_tiers(spark, sf):
    m, a = both_prepared(spark, sf)
    return flat(tiered_match_except(staged(m, "union-movies"), staged(a, "union-articles")))


def q_tiered_match(spark, sf):
    return flat(matched(spark, sf))


def q_tiered_match_dups(spark, sf):
    part = _table(spark, sf, "part")
    return flat(tiered_match(prepare_movies(movie_view_with_copies(spark, sf, part)), articles(spark, sf, part)))


def q_tiered_match_hot(spark, sf):
    """Half of all articles under one title, some movies' own."""
    m, a = both_prepared(spark, sf)
    m, a = staged(m, "hot-movies"), staged(a, "hot-articles")
    title = F.broadcast(m.agg(F.min(C.CLEANED_TITLE).alias("_title")))
    more = a.crossJoin(title).withColumn(C.CLEANED_TITLE, F.col("_title")).select(*a.columns)  # with one row
    every = staged(a.union(more), "hot-articles")
    return flat(tiered_match(m, every, heavy=heavy_keys(every)))


def q_match_top_k(spark, sf):
    return top_k(flat(matched(spark, sf)), C.REVENUE_TO_BUDGET, TOP_K_ROWS, tie_breakers=OUTPUT_TIE_BREAKERS)


def q_explode_genres(spark, sf):
    return flat(explode_column(matched(spark, sf), C.GENRES))


EXPLODED = f"{C.PRODUCTION_COMPANIES}_exploded"
EXPLODED_TIE_BREAKERS = [EXPLODED, *[c for c in OUTPUT_TIE_BREAKERS if c != C.PRODUCTION_COMPANIES]]


def q_top_exploded(spark, sf):
    m = matched(spark, sf).withColumn(C.GENRES, F.array_join(C.GENRES, "|"))
    return top_exploded(
        m, C.PRODUCTION_COMPANIES, C.REVENUE_TO_BUDGET, TOP_EXPLODED_ROWS, tie_breakers=EXPLODED_TIE_BREAKERS
    )


def q_distinct_companies(spark, sf):
    top = q_top_exploded(spark, sf)
    return distinct_values(top, EXPLODED, [(C.REVENUE_TO_BUDGET, "desc"), *EXPLODED_TIE_BREAKERS]).select(EXPLODED)


def q_first_seen_companies(spark, sf):
    """Every company and its place in the order of first appearance over all
    exploded rows."""
    rows = explode_column(matched(spark, sf).withColumn(C.GENRES, F.array_join(C.GENRES, "|")), C.PRODUCTION_COMPANIES)
    seen = distinct_values(rows, EXPLODED, [(C.REVENUE_TO_BUDGET, "desc"), *EXPLODED_TIE_BREAKERS[1:]])
    places = numbered(seen, [F.col("first_seen").asc(), F.col(EXPLODED).asc()], "place")
    return places.select(EXPLODED, F.col("place").cast("int").alias("place"))


WIDE_PART = 3


def q_top_k_wide(spark, sf):
    """A third of all order lines by price: a top-k too wide for one task."""
    lines = staged(_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "lines")
    n = lines.count() // WIDE_PART
    return top_k_wide(lines, "l_extendedprice", n, tie_breakers=["l_orderkey", "l_linenumber"])


def q_row_counts(spark, sf):
    """The counts the job reports, by its own staging."""
    with scope(spark):
        _, _, n_movies, n_articles = staged_sources(*both_prepared(spark, sf), new_folder(spark, "counts"))
    return spark.createDataFrame([("movies", n_movies), ("articles", n_articles)], "table_name string, n long")


def q_job_match(spark, sf):
    """The job from its prepared tables on: candidates, match, top rows."""
    m, a = both_prepared(spark, sf)
    return flat(ranked(tiered_match(m, candidates(a, m))))


def q_sort_ascending(spark, sf):
    """The other end of the order: the rows with the lowest ratios, NULLs first."""
    return flat(top_k(matched(spark, sf), C.REVENUE_TO_BUDGET, TOP_K_ROWS, ascending=True, tie_breakers=RESULT_TIE_BREAKERS))


def q_sql_select(spark, sf):
    return run_sql(
        spark,
        "SELECT title, year, url, revenue_to_budget FROM {movies} WHERE url IS NOT NULL AND revenue_to_budget >= 1",
        movies=matched(spark, sf),
    )


# Fixed value: number strings that casts tend to get wrong, one kind a part.
EDGE_STRINGS = """
CASE p_partkey % 16
  WHEN 0 THEN concat(CAST(p_size AS VARCHAR(10)), 'e3') WHEN 1 THEN '1E7' WHEN 2 THEN concat(CAST(p_size AS VARCHAR(10)), '.9')
  WHEN 3 THEN concat(CAST(p_size AS VARCHAR(10)), '.99999999999') WHEN 4 THEN '0.99999999999' WHEN 5 THEN '.5'
  WHEN 6 THEN concat(CAST(p_size AS VARCHAR(10)), '.') WHEN 7 THEN concat('+', CAST(p_size AS VARCHAR(10)))
  WHEN 8 THEN concat('  ', CAST(p_size AS VARCHAR(10)), ' ') WHEN 9 THEN '  ' WHEN 10 THEN '' WHEN 11 THEN 'n/a'
  WHEN 12 THEN concat('922337203685477580', CAST(p_partkey % 10 AS VARCHAR(10)))
  WHEN 13 THEN concat('-922337203685477580', CAST(p_partkey % 10 AS VARCHAR(10)), '.9')
  WHEN 14 THEN concat('-', CAST(p_size AS VARCHAR(10)), '.5') ELSE '1.2.3' END
"""


def q_cast_edges(spark, sf):
    rows = _table(spark, sf, "part").select("p_partkey", F.expr(EDGE_STRINGS).alias("raw"))
    return cast_columns(rows.withColumn("value", F.col("raw")), {"value": "long"})


CSV_SCHEMA = "id STRING, title STRING, genres STRING, budget STRING, revenue STRING"


def csv_lines(mv: DataFrame) -> DataFrame:
    """Movie rows as CSV lines in the catalogue's dialect: Python-repr lists
    with doubled apostrophes inside double-quoted fields, as the raw movie
    file has them."""
    q = F.lit('"')
    repr_list = F.regexp_replace(F.translate(C.GENRES, '"', "'"), "'", "''")
    return mv.select(
        F.concat_ws(
            ",",
            F.col("id").cast("string"),
            F.concat(q, F.col(C.TITLE), q),
            F.concat(q, repr_list, q),
            F.col(C.BUDGET),
            F.col(C.REVENUE),
        ).alias("line")
    )


def q_csv_parse(spark, sf):
    lines = csv_lines(movie_view(spark, sf))
    opts = {k: v for k, v in APOSTROPHE_ESCAPE.options().items() if k in ("sep", "quote", "escape")}
    rows = lines.select(F.from_csv("line", CSV_SCHEMA, opts).alias("r")).select("r.*")
    rows = cast_columns(rows, {"id": "long", C.GENRES: MOVIE_TYPES[C.GENRES]})
    return flat(pluck(rows, [C.GENRES], "name")).select("id", C.TITLE, C.GENRES, C.BUDGET, C.REVENUE)


def xml_chunks(av: DataFrame) -> DataFrame:
    """Article rows as the splittable reader's chunks: what follows one opening
    tag up to the next.  Attributes, white space in closing tags, closing tags
    inside CDATA, comments, text outside the BMP and comments that name the row
    tag come in turns."""
    turn = F.pmod(F.hash(C.URL), F.lit(4))

    def one_of(*texts: str) -> F.Column:
        return F.element_at(F.array(*map(F.lit, texts)), turn + 1)

    record = F.concat(
        one_of(">", ' id="7">', " a='x>y' b = \"\U0001d11e\">", "\n>"),
        F.lit("\n    <title>"),
        F.col(C.TITLE),
        F.lit("</title>\n    <url>"),
        F.col(C.URL),
        one_of("</url><abstract>", "</url> <!-- </doc> --> <abstract><![CDATA[", "</url><abstract>", "</url><abstract>"),
        F.col(C.ABSTRACT),
        one_of("</abstract>", "]]></abstract>", "</abstract>", "</abstract>"),
        F.lit('<links><sublink linktype="nav"><anchor>History</anchor><link>'),
        F.col(C.URL),
        one_of("#H</link></sublink></links>", "</link></sublink><!-- x --></links>", "<![CDATA[</doc>]]></link></sublink></links>", "</link></sublink></links>"),
        one_of("</doc>\n  ", "</doc >\n", "</doc\n> \U0001f600 ", "</doc> <!-- \U0001f600 --> <!-- a "),
    )
    after = F.when(turn == 3, F.lit("> tag in a comment -->\n"))
    return av.select(F.explode(F.filter(F.array(record, after), lambda x: x.isNotNull())).alias("value"))


def q_xml_parse(spark, sf):
    rec = xml_records(xml_chunks(article_view(spark, sf)), "doc")
    raw = rec.select(F.from_xml("record", ARTICLE_SCHEMA_PRUNED, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return prepare_articles(raw)


def _text_files(lines: DataFrame, name: str) -> str:
    path = new_folder(lines.sparkSession, name)
    lines.write.text(path)
    return path


def q_csv_scan(spark, sf):
    """The same lines as files of the movie catalogue, read by its reader."""
    path = _text_files(csv_lines(movie_view(spark, sf)), "movies-csv")
    rows = read_delimited(spark, path, replace(APOSTROPHE_ESCAPE, header=False), CSV_SCHEMA)
    rows = cast_columns(rows, {"id": "long", C.GENRES: MOVIE_TYPES[C.GENRES]})
    return flat(pluck(rows, [C.GENRES], "name")).select("id", C.TITLE, C.GENRES, C.BUDGET, C.REVENUE)


def q_xml_scan(spark, sf):
    """The article chunks as XML files, read in splits."""
    path = _text_files(xml_chunks(article_view(spark, sf)).select(F.concat(F.lit("<doc"), "value")), "articles-xml")
    return prepare_articles(read_articles(spark, path))


def q_xml_scan_lexed(spark, sf):
    """XML files whose records name the row tag in comments, CDATA sections and
    nested elements, which only lexing across splits can cut."""
    chunks = xml_chunks(article_view(spark, sf)).select(F.concat(F.lit("<doc"), "value").alias("value"))
    odd = F.concat(F.lit("<!-- <doc/> --><doc><links><doc>inner <![CDATA[<doc> </doc>]]></doc>\n<doc/></links>"), F.substring("value", 6, 1 << 30))
    plain = F.col("value").startswith("<doc><") & F.col("value").contains("</doc")
    path = _text_files(chunks.select(F.when(plain, odd).otherwise(F.col("value"))), "articles-odd-xml")
    return prepare_articles(read_articles(spark, path, lexed=True))


QUERIES: dict[str, Query] = {
    "url_parse": q_url_parse,
    "url_parse_pages": q_url_parse_pages,
    "clean_title": q_clean_title,
    "project_rename": q_project_rename,
    "cast_types": q_cast_types,
    "filter_set": q_filter_set,
    "json_names": q_json_names,
    "json_props": q_json_props,
    "ratio": q_ratio,
    "year_of_date": q_year_of_date,
    "movies_prepared": q_movies_prepared,
    "articles_prepared": q_articles_prepared,
    "join_title_year": q_join_title_year,
    "join_title": q_join_title,
    "left_join_title": q_left_join_title,
    "except_matched": q_except_matched,
    "union_tiers": q_union_tiers,
    "tiered_match": q_tiered_match,
    "tiered_match_dups": q_tiered_match_dups,
    "tiered_match_hot": q_tiered_match_hot,
    "match_top_k": q_match_top_k,
    "explode_genres": q_explode_genres,
    "top_exploded": q_top_exploded,
    "distinct_companies": q_distinct_companies,
    "first_seen_companies": q_first_seen_companies,
    "top_k_wide": q_top_k_wide,
    "csv_scan": q_csv_scan,
    "xml_scan": q_xml_scan,
    "xml_scan_lexed": q_xml_scan_lexed,
    "row_counts": q_row_counts,
    "job_match": q_job_match,
    "sort_ascending": q_sort_ascending,
    "cast_edges": q_cast_edges,
    "sql_select": q_sql_select,
    "csv_parse": q_csv_parse,
    "xml_parse": q_xml_parse,
}


# ----------------------------------------------------------- DuckDB oracle

_P = ARTICLE_URL_PATTERN
_NAMES = """list_transform(from_json({c}, '[{{"id":"INTEGER","name":"VARCHAR"}}]'), lambda x: x.name)"""
_LONG = "TRY_CAST({c} AS BIGINT)"

_URL_PARTS = (
    f"lower(trim(replace(CASE WHEN regexp_extract(url, '{_P}', 2) = '' AND regexp_extract(url, '{_P}', 3) = '' "
    f"THEN (string_split(url, '/'))[-1] ELSE regexp_extract(url, '{_P}', 1) END, '_', ' '))) AS cleaned_title, "
    f"regexp_extract(url, '{_P}', 2) AS year, regexp_extract(url, '{_P}', 3) AS type"
)

def _base(movie_source: str) -> str:
    return f"""
WITH mv AS ({movie_source}),
av AS ({for_duckdb(ARTICLE_VIEW)}),
m AS (
  SELECT title,
         CAST(year(TRY_CAST(release_date AS DATE)) AS VARCHAR) AS year,
         {_NAMES.format(c="production_companies")} AS production_companies,
         {_NAMES.format(c="genres")} AS genres,
         vote_average AS rating,
         {_LONG.format(c="revenue")} AS revenue,
         {_LONG.format(c="budget")} AS budget,
         CAST((200 * {_LONG.format(c="revenue")} + {_LONG.format(c="budget")}) // (2 * {_LONG.format(c="budget")}) AS DOUBLE) / 100
             AS revenue_to_budget,
         lower(trim(title)) AS cleaned_title
  FROM mv
  WHERE title <> '' AND {_LONG.format(c="revenue")} > 0 AND {_LONG.format(c="budget")} > 0
),
a AS (
  SELECT abstract, url, {_URL_PARTS}
  FROM av
),
t1 AS (
  SELECT m.*, a.url, a.abstract FROM m JOIN a ON m.cleaned_title = a.cleaned_title AND m.year = a.year
  WHERE a.year <> '' AND a.type = 'film'
),
r1 AS (
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, cleaned_title FROM m
  EXCEPT
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, cleaned_title FROM t1
),
t2 AS (
  SELECT r1.*, a.url, a.abstract FROM r1 JOIN a ON r1.cleaned_title = a.cleaned_title
  WHERE a.year = '' AND a.type = 'film'
),
r2 AS (
  SELECT * FROM r1
  EXCEPT
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, cleaned_title FROM t2
),
t3 AS (
  SELECT r2.*, a3.url, a3.abstract FROM r2
  LEFT JOIN (SELECT * FROM a WHERE year = '' AND type = '') a3 ON r2.cleaned_title = a3.cleaned_title
),
matched AS (
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, url, abstract FROM t1
  UNION ALL
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, url, abstract FROM t2
  UNION ALL
  SELECT title, year, production_companies, genres, rating, revenue, budget, revenue_to_budget, url, abstract FROM t3
),
matched_flat AS (
  SELECT title, year, array_to_string(production_companies, '|') AS production_companies,
         array_to_string(genres, '|') AS genres, rating, revenue, budget, revenue_to_budget, url, abstract
  FROM matched
)
"""


_BASE = _base(for_duckdb(MOVIE_VIEW))
_HOT = _BASE.replace("\na AS (", "\na0 AS (").replace(
    "\nt1 AS (",
    "\na AS (SELECT * FROM a0 UNION ALL SELECT abstract, url, (SELECT min(cleaned_title) FROM m) AS cleaned_title, year, type FROM a0),\nt1 AS (",
)
_MOVIES_WITH_COPIES = (
    f"SELECT * FROM ({for_duckdb(MOVIE_VIEW)}) v0 UNION ALL "
    f"SELECT id, title, CASE WHEN vote_average IN ('0', '1', '2') THEN 'unknown' ELSE release_date END AS release_date, "
    f"budget, revenue, vote_average, genres, production_companies FROM ({for_duckdb(MOVIE_VIEW)}) v1"
)


_TIES = "title ASC NULLS FIRST, year ASC NULLS FIRST, url ASC NULLS FIRST, rating ASC NULLS FIRST, " \
    "revenue ASC NULLS FIRST, budget ASC NULLS FIRST, abstract ASC NULLS FIRST, genres ASC NULLS FIRST"

_TOP_EXPLODED = f"""
top AS (
  SELECT title, year, array_to_string(genres, '|') AS genres, rating, revenue, budget, revenue_to_budget, url,
         abstract, unnest(production_companies) AS production_companies_exploded
  FROM matched
),
top_n AS (
  SELECT * FROM top
  ORDER BY revenue_to_budget DESC NULLS LAST, production_companies_exploded ASC NULLS FIRST, {_TIES}
  LIMIT {TOP_EXPLODED_ROWS}
)
"""

ORACLE_SQL: dict[str, str] = {
    "url_parse": f"WITH av AS ({for_duckdb(ARTICLE_VIEW)}) SELECT title, url, {_URL_PARTS} FROM av",
    "url_parse_pages": f"SELECT page_id, url, {_URL_PARTS} FROM pages",
    "clean_title": _BASE + "SELECT id, title, lower(trim(title)) AS cleaned_title FROM mv",
    "project_rename": _BASE + "SELECT id, title, genres, production_companies, vote_average AS rating, budget, revenue FROM mv",
    "cast_types": _BASE + f"SELECT id, {_LONG.format(c='budget')} AS budget, {_LONG.format(c='revenue')} AS revenue, "
    "CAST(year(TRY_CAST(release_date AS DATE)) AS VARCHAR) AS year FROM mv",
    "filter_set": _BASE + f"SELECT id, title, {_LONG.format(c='budget')} AS budget, {_LONG.format(c='revenue')} AS revenue "
    f"FROM mv WHERE title <> '' AND {_LONG.format(c='revenue')} > 0 AND {_LONG.format(c='budget')} > 0",
    "json_names": _BASE + f"SELECT id, array_to_string({_NAMES.format(c='genres')}, '|') AS genres, "
    f"array_to_string({_NAMES.format(c='production_companies')}, '|') AS production_companies FROM mv",
    "json_props": """SELECT event_id, from_json(props, '{"k":"INTEGER"}').k AS k FROM events""",
    "ratio": _BASE + "SELECT title, year, revenue, budget, revenue_to_budget FROM m",
    "year_of_date": "SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS o_year FROM orders",
    "movies_prepared": _BASE + "SELECT title, year, array_to_string(production_companies, '|') AS production_companies, "
    "array_to_string(genres, '|') AS genres, rating, revenue, budget, revenue_to_budget, cleaned_title FROM m",
    "articles_prepared": _BASE + "SELECT abstract, url, cleaned_title, year, type FROM a",
    "join_title_year": _BASE + "SELECT title, year, array_to_string(production_companies, '|') AS production_companies, "
    "array_to_string(genres, '|') AS genres, rating, revenue, budget, revenue_to_budget, url, abstract FROM t1",
    "join_title": _BASE + "SELECT m.title, m.year, array_to_string(m.production_companies, '|') AS production_companies, "
    "array_to_string(m.genres, '|') AS genres, m.rating, m.revenue, m.budget, m.revenue_to_budget, a.url, a.abstract "
    "FROM m JOIN a ON m.cleaned_title = a.cleaned_title WHERE a.year = '' AND a.type = 'film'",
    "left_join_title": _BASE + "SELECT m.title, m.year, array_to_string(m.production_companies, '|') AS production_companies, "
    "array_to_string(m.genres, '|') AS genres, m.rating, m.revenue, m.budget, m.revenue_to_budget, a3.url, a3.abstract "
    "FROM m LEFT JOIN (SELECT * FROM a WHERE year = '' AND type = '') a3 ON m.cleaned_title = a3.cleaned_title",
    "except_matched": _BASE + "SELECT title, year, array_to_string(production_companies, '|') AS production_companies, "
    "array_to_string(genres, '|') AS genres, rating, revenue, budget, revenue_to_budget, cleaned_title FROM r1",
    "union_tiers": _BASE + "SELECT * FROM matched_flat",
    "tiered_match": _BASE + "SELECT * FROM matched_flat",
    "tiered_match_dups": _base(_MOVIES_WITH_COPIES) + "SELECT * FROM matched_flat",
    "tiered_match_hot": _HOT + "SELECT * FROM matched_flat",
    "match_top_k": _BASE + "SELECT * FROM matched_flat ORDER BY revenue_to_budget DESC NULLS LAST, "
    f"{_TIES}, production_companies ASC NULLS FIRST LIMIT {TOP_K_ROWS}",
    "explode_genres": _BASE + "SELECT title, year, production_companies, rating, revenue, budget, revenue_to_budget, "
    "url, abstract, unnest(genres) AS genres_exploded FROM (SELECT title, year, "
    "array_to_string(production_companies, '|') AS production_companies, genres, rating, revenue, budget, "
    "revenue_to_budget, url, abstract FROM matched)",
    "top_exploded": _BASE.rstrip() + "," + _TOP_EXPLODED + "SELECT * FROM top_n",
    "distinct_companies": _BASE.rstrip() + "," + _TOP_EXPLODED + "SELECT DISTINCT production_companies_exploded "
    "FROM top_n",
    "first_seen_companies": _BASE.rstrip() + "," + _TOP_EXPLODED + f"""SELECT production_companies_exploded,
  CAST(dense_rank() OVER (ORDER BY place) AS INT) AS place
FROM (
  SELECT production_companies_exploded, min(place) AS place
  FROM (SELECT *, row_number() OVER (ORDER BY revenue_to_budget DESC NULLS LAST, {_TIES}, production_companies_exploded) AS place FROM top)
  GROUP BY 1
)""",
    "top_k_wide": """SELECT l_orderkey, l_linenumber, l_extendedprice
FROM (SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS n FROM lineitem)
WHERE n <= (SELECT count(*) // 3 FROM lineitem)""",
    "job_match": _BASE + "SELECT * FROM matched_flat ORDER BY revenue_to_budget DESC NULLS LAST, "
    f"{_TIES}, production_companies ASC NULLS FIRST LIMIT {TOP_K_ROWS}",
    "sort_ascending": _BASE + "SELECT * FROM matched_flat ORDER BY revenue_to_budget ASC NULLS FIRST, "
    f"{_TIES}, production_companies ASC NULLS FIRST LIMIT {TOP_K_ROWS}",
    "cast_edges": f"""
WITH v AS (SELECT p_partkey, {EDGE_STRINGS} AS raw FROM part),
t AS (SELECT *, trim(raw, ' ' || chr(9)) AS s FROM v),
p AS (SELECT *, regexp_extract(s, '^([+-]?[0-9]*)([.][0-9]*)?$', 1) AS i,
  regexp_matches(s, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$') AS ok FROM t)
SELECT p_partkey, raw, CASE WHEN ok THEN
    CASE WHEN i IN ('', '+', '-') THEN 0 ELSE TRY_CAST(TRY_CAST(i AS HUGEINT) AS BIGINT) END END AS value
FROM p
""",
    "row_counts": _BASE + "SELECT 'movies' AS table_name, count(*) AS n FROM m UNION ALL "
    "SELECT 'articles' AS table_name, count(*) AS n FROM a",
    "sql_select": _BASE + "SELECT title, year, url, revenue_to_budget FROM matched WHERE url IS NOT NULL "
    "AND revenue_to_budget >= 1",
    "csv_parse": _BASE + "SELECT id, title, array_to_string(" + _NAMES.format(c="genres") + ", '|') AS genres, "
    "budget, revenue FROM mv",
    "xml_parse": _BASE + "SELECT abstract, url, cleaned_title, year, type FROM a",
}
ORACLE_SQL["csv_scan"] = ORACLE_SQL["csv_parse"]
ORACLE_SQL["xml_scan"] = ORACLE_SQL["xml_scan_lexed"] = ORACLE_SQL["xml_parse"]
