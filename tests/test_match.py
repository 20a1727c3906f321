"""Tiered match: scalable form vs the join/EXCEPT/union specification."""

from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from titlematch.operators.match import Tier, tiered_match, tiered_match_except

MOVIE_SCHEMA = (
    "title string, year string, production_companies array<string>, genres array<string>, rating string, "
    "revenue bigint, budget bigint, revenue_to_budget double, cleaned_title string"
)
ARTICLE_SCHEMA = "abstract string, url string, cleaned_title string, year string, type string"


def movie(title, year, ratio=1.0, companies=("C",), genres=("G",)):
    return (title, year, list(companies) if companies is not None else None, list(genres), "5", 10, 10, ratio, title.lower().strip())


def article(title_key, year, kind, url=None):
    return ("abs " + (url or title_key), url or f"u/{title_key}_{year}_{kind}", title_key, year, kind)


def both(spark, movies, articles, **kw):
    m = spark.createDataFrame(movies, MOVIE_SCHEMA)
    a = spark.createDataFrame(articles, ARTICLE_SCHEMA)
    fast = tiered_match(m, a, **kw)
    slow = tiered_match_except(m, a, **{k: v for k, v in kw.items() if k in ("tiers", "unmatched", "output_columns")})
    return rows(fast), rows(slow)


def test_tier_priority_and_fanout(spark):
    movies = [movie("Glass Orchard", "1933"), movie("Glass Orchard", "2005"), movie("Harbour Lights", "2002"), movie("Lonely", "1999")]
    articles = [
        article("glass orchard", "1933", "film", "GO_1933"),
        article("glass orchard", "1976", "film", "GO_1976"),
        article("glass orchard", "", "comics", "GO_comics"),
        article("glass orchard", "1959", "musical", "GO_musical"),
        article("harbour lights", "", "", "HL_plain"),
        article("harbour lights", "", "film", "HL_film"),
        article("harbour lights", "", "film", "HL_film_2"),
    ]
    fast, slow = both(spark, movies, articles)
    assert fast == slow
    urls = Counter((r[0], r[1], r[8]) for r in fast)
    assert urls == Counter(
        {
            ("Glass Orchard", "1933", "GO_1933"): 1,
            ("Glass Orchard", "2005", None): 1,  # year mismatch, no tier-2/3 article
            ("Harbour Lights", "2002", "HL_film"): 1,  # tier 2 beats tier 3
            ("Harbour Lights", "2002", "HL_film_2"): 1,  # all articles of the winning tier
            ("Lonely", "1999", None): 1,
        }
    )


def test_duplicates_kept_in_first_tier_collapsed_later(spark):
    movies = [movie("A", "2000")] * 3 + [movie("B", "2000")] * 3 + [movie("C", "2000")] * 2
    articles = [article("a", "2000", "film"), article("b", "", "film"), article("b", "", "film", "b2")]
    fast, slow = both(spark, movies, articles)
    assert fast == slow
    c = Counter(r[0] for r in fast)
    assert c == {"A": 3, "B": 2, "C": 1}


def test_null_year_and_null_title(spark):
    movies = [movie("A", None), movie("A", "2000"), ("x", "2000", ["C"], ["G"], "5", 1, 1, 1.0, None)]
    articles = [article("a", "2000", "film"), article("a", "", ""), (None, "u/null", None, "", "")]
    fast, slow = both(spark, movies, articles)
    assert fast == slow
    got = {(r[0], r[1]): r[8] for r in fast}
    assert got[("A", None)] == "u/a__"  # NULL year falls through to tier 3
    assert got[("A", "2000")] == "u/a_2000_film"
    assert got[("x", "2000")] is None


def test_unmatched_drop(spark):
    movies = [movie("A", "2000"), movie("B", "2000")]
    articles = [article("a", "", "")]
    fast, slow = both(spark, movies, articles, unmatched="drop")
    assert fast == slow
    assert [(r[0], r[8]) for r in fast] == [("A", "u/a__")]


@pytest.mark.parametrize("opts", [{"broadcast_keys": True}, {"prefilter_right": True}, {"broadcast_keys": True, "prefilter_right": True}])
def test_options_do_not_change_results(spark, opts):
    movies = [movie("A", "2000")] * 2 + [movie("B", None), movie("C", "1990")]
    articles = [article("a", "2000", "film"), article("b", "", ""), article("zz", "", "")]
    fast, slow = both(spark, movies, articles, **opts)
    assert fast == slow


def test_custom_tiers(spark):
    tiers = (Tier("exact", ("cleaned_title", "year"), "type = 'film'"), Tier("any", ("cleaned_title",), "true"))
    movies = [movie("A", "2000"), movie("B", "2001")]
    articles = [article("a", "2000", "film"), article("a", "", "x"), article("b", "1999", "film")]
    fast, slow = both(spark, movies, articles, tiers=tiers)
    assert fast == slow
    assert {(r[0], r[8]) for r in fast} == {("A", "u/a_2000_film"), ("B", "u/b_1999_film")}


def test_missing_key_rejected(spark):
    m = spark.createDataFrame([movie("A", "2000")], MOVIE_SCHEMA).drop("year")
    a = spark.createDataFrame([article("a", "", "")], ARTICLE_SCHEMA)
    with pytest.raises(ValueError):
        tiered_match(m, a)


def test_plan_has_no_cross_product_and_one_final_join(spark):
    m = spark.createDataFrame([movie("A", "2000")], MOVIE_SCHEMA)
    a = spark.createDataFrame([article("a", "", "")], ARTICLE_SCHEMA)
    plan = tiered_match(m, a)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # matched and unmatched rows come out of one left join, not a union of
    # branches: the optimized plan is a projection over that join
    top = tiered_match(m, a)._jdf.queryExecution().optimizedPlan().toString().split("\n")[:2]
    assert top[0].startswith("Project") and "Join LeftOuter" in top[1]


titles = st.sampled_from(["a", "b", "c"])
years = st.sampled_from(["1990", "2000", None])
kinds = st.sampled_from(["film", "", "comics"])


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    ms=st.lists(st.tuples(titles, years, st.sampled_from([1.0, 2.0])), min_size=0, max_size=8),
    arts=st.lists(st.tuples(titles, st.sampled_from(["1990", "2000", ""]), kinds), min_size=0, max_size=8),
)
def test_property_forms_agree(spark, ms, arts):
    movies = [movie(t.upper(), y, r) for t, y, r in ms]
    articles = [article(t, y, k, f"u{i}") for i, (t, y, k) in enumerate(arts)]
    fast, slow = both(spark, movies, articles)
    assert fast == slow
