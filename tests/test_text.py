"""URL parsing and title cleaning (golden tables)."""

import pytest
from conftest import rows

from titlematch.functions.text import clean_title, url_last_segment
from titlematch.operators.urls import parse_article_url

BASE = "https://en.example.org/wiki/"


def test_parse_keeps_the_other_columns(spark):
    df = spark.createDataFrame([(1, BASE + "Paper_Moth_(2013_film)"), (2, BASE + "Paper_Moth")], ["n", "url"])
    out = parse_article_url(df)
    assert out.columns == ["n", "url", "cleaned_title", "year", "type"]
    assert rows(out.drop("url")) == [(1, "paper moth", "2013", "film"), (2, "paper moth", "", "")]


EDGES = [
    ("Tillman_Mill", "tillman mill", "", ""),
    ("Glass_Orchard_(1954_film)", "glass orchard", "1954", "film"),
    ("Q_(film)", "q", "", "film"),
    ("Paper_Moth_(TV_series)", "paper moth", "", "TV_series"),
    ("Y_(2013_Danish_film)", "y", "2013", "Danish_film"),
    ("Y_(451)", "y", "451", ""),
    ("Y_()", "y ()", "", ""),
    ("E/F_(film)", "f", "", "film"),
    ("Up/Down", "down", "", ""),
    ("P_(q)_(1991_film)", "p (q)", "1991", "film"),
    ("Moth_(film)_index", "moth", "", "film"),
    ("Y_(1954film)", "y", "1954", "film"),
    ("Y_(film,_1999)", "y (film, 1999)", "", ""),
    ("Y_(été_film)", "y (été film)", "", ""),
    ("Caf%C3%A9_(film)", "caf%c3%a9", "", "film"),
    ("😀_Moth_(1999_film)", "😀 moth", "1999", "film"),
]


@pytest.mark.parametrize("last,title,year,kind", EDGES)
def test_url_edge_cases(spark, last, title, year, kind):
    df = spark.createDataFrame([(BASE + last,)], ["url"])
    r = parse_article_url(df).first()
    assert (r.cleaned_title, r.year, r.type) == (title, year, kind)


def test_null_url_gives_nulls(spark):
    df = spark.createDataFrame([(None,)], "url string")
    r = parse_article_url(df).first()
    assert (r.cleaned_title, r.year, r.type) == (None, None, None)


def test_parse_uses_given_column(spark):
    df = spark.createDataFrame([("x", BASE + "Some_Page")], ["url", "link"])
    r = parse_article_url(df, "link").first()
    assert r.cleaned_title == "some page"


def test_clean_title_and_last_segment(spark):
    df = spark.createDataFrame([("  Paper Moth ",), ("Up/Down",), (None,)], ["t"])
    got = rows(df.select(clean_title("t").alias("c"), url_last_segment("t").alias("s")))
    assert got == rows(spark.createDataFrame([("paper moth", "  Paper Moth "), ("up/down", "Down"), (None, None)], ["c", "s"]))


def test_movie_title_keeps_underscores(spark):
    df = spark.createDataFrame([("Some_Title",)], ["title"])
    assert df.select(clean_title("title")).first()[0] == "some_title"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from titlematch.functions.text import ARTICLE_URL_PATTERN, url_parts  # noqa: E402

url_text = st.text(alphabet=list("ab1_9/()-é ,\n\r\u0001😀"), min_size=0, max_size=24)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(url_text, min_size=1, max_size=200))
def test_parse_equals_plain_regex(spark, urls):
    """The one-expression parse equals plain regexp_extract with the fixed
    pattern on arbitrary path-like strings."""
    df = spark.createDataFrame([(u,) for u in urls] + [(None,)], "url string")
    stem, year, kind = [F.regexp_extract("url", ARTICLE_URL_PATTERN, i) for i in (1, 2, 3)]
    raw = F.when((year == "") & (kind == ""), F.element_at(F.split("url", "/"), -1)).otherwise(stem)
    plain = df.select(F.lower(F.trim(F.regexp_replace(raw, "_", " "))), year, kind)
    assert rows(parse_article_url(df).drop("url")) == rows(plain)
    assert rows(df.select(*url_parts("url"))) == rows(plain)


def test_custom_patterns_are_taken_as_they_are(spark):
    def parse(url, pattern):
        r = parse_article_url(spark.createDataFrame([(url,)], ["url"]), pattern=pattern).first()
        return r.cleaned_title, r.year, r.type

    assert parse(BASE + "Paper_Moth_1954_film", r"([^/]*)_(\d{4})_(\w+)") == ("paper moth", "1954", "film")
    assert parse(BASE + "x-1954-film", r"([^-]*)-(\d+)-(\w+)") == (BASE + "x", "1954", "film")


def test_one_regex_per_url(spark):
    df = spark.createDataFrame([(BASE + "Q_(film)",)], ["url"])
    plan = parse_article_url(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp") == 1
