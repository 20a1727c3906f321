"""Column names shared by the movie and article tables.

Fixed values: these names must equal the reference's output schema.
The movie year and the article year share the name ``year`` on purpose;
the first match tier joins on it by name.
"""

# Fixed values (output schema names).
URL = "url"
YEAR = "year"
TYPE = "type"
ABSTRACT = "abstract"
TITLE = "title"
GENRES = "genres"
PRODUCTION_COMPANIES = "production_companies"
RELEASE_DATE = "release_date"
VOTE_AVERAGE = "vote_average"
BUDGET = "budget"
REVENUE = "revenue"
RATING = "rating"
REVENUE_TO_BUDGET = "revenue_to_budget"
CLEANED_TITLE = "cleaned_title"

# Raw movie columns the job reads, in this order.
MOVIE_KEY_COLUMNS = [TITLE, GENRES, PRODUCTION_COMPANIES, RELEASE_DATE, VOTE_AVERAGE, BUDGET, REVENUE]

# Prepared movie table, in this order.
MOVIE_COLUMNS = [
    TITLE,
    YEAR,
    PRODUCTION_COMPANIES,
    GENRES,
    RATING,
    REVENUE,
    BUDGET,
    REVENUE_TO_BUDGET,
    CLEANED_TITLE,
]

# Prepared article table, in this order.
ARTICLE_COLUMNS = [ABSTRACT, URL, CLEANED_TITLE, YEAR, TYPE]

# Match output, in this order.
OUTPUT_COLUMNS = [
    TITLE,
    YEAR,
    PRODUCTION_COMPANIES,
    GENRES,
    RATING,
    REVENUE,
    BUDGET,
    REVENUE_TO_BUDGET,
    URL,
    ABSTRACT,
]
