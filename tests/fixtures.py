"""Small sources written by the tests, a row or two for each rule of the job."""

import os
from collections import Counter
from xml.sax.saxutils import escape

# Fixed value: the columns of the movie file.
MOVIE_HEADER = (
    "adult,belongs_to_collection,budget,genres,homepage,id,imdb_id,original_language,original_title,overview,"
    "popularity,poster_path,production_companies,production_countries,release_date,revenue,runtime,"
    "spoken_languages,status,tagline,title,video,vote_average,vote_count"
)




def named(names, doubled=False):
    """A list column: Python's notation in a quoted field, its apostrophes plain or doubled."""
    text = "[" + ", ".join(f"{{'id': {len(n)}, 'name': '{n}'}}" for n in names) + "]"
    return '"' + (text.replace("'", "''") if doubled else text) + '"'


def movie_line(name, release, budget, revenue, companies=(), kinds=("Drama",), vote="5.5", doubled=False, **raw):
    """A line of the movie file; ``raw`` gives columns as they are."""
    own = {
        "title": f'"{name}"', "original_title": f'"{name}"', "release_date": release, "budget": budget, "revenue": revenue, "vote_average": vote,
        "production_companies": named(companies, doubled), "genres": named(kinds, doubled), "overview": "\"Text, with a comma and an apostrophe''s pair.\"",
    } | raw
    return ",".join(own.get(c, "") for c in MOVIE_HEADER.split(","))


# (line, what becomes of it): the url ends it is linked with, None alone for
# unmatched, nothing for dropped
CASES = [
    # the first tier keeps duplicates, and takes every article of title and year
    (movie_line("Copper Tide", "1994-07-01", "2000000", "7000000", ["Kelp"]), ["Copper_Tide_(1994_film)", "copper_tide_(1994_film)"]),
    (movie_line("Copper Tide", "1994-07-01", "2000000", "7000000", ["Kelp"]), ["Copper_Tide_(1994_film)", "copper_tide_(1994_film)"]),
    # no year, no first tier
    (movie_line("Copper Tide", "unknown", "1000000", "1250000", doubled=True), ["Copper_Tide_(film)"]),
    # one title in two years: the year decides the tier
    (movie_line("Basalt", "1979-01-31", "8000000", "6000000", ["Ninefold"]), ["Basalt_(film)"]),
    (movie_line("Basalt", "1980-12-31", "1000000", "9000000", ["Ninefold", "Arbor & Sons"], doubled=True), ["Basalt_(1980_film)"]),
    # only a plain article; no company
    (movie_line("Vesper & Co", "2003-03-03", "1100000", "3300000", kinds=()), ["Vesper_&_Co"]),
    # the only article has a type that no tier takes; the budget's fraction goes
    (movie_line("Quarry Road", "1967-05-05", "12.9", "100", ["Kelp"]), [None]),
    # spaces and capitals do not count
    (movie_line(" LAMP Post ", "1999-09-09", "4", "2"), ["Lamp_Post_(1999_film)"]),
    # duplicates outside the first tier are one row, matched or not
    (movie_line("Twelve Kites", "2010-10-10", "4000", "10000", ["Umber", "Kelp"]), ["Twelve_Kites"]),
    (movie_line("Twelve Kites", "2010-10-10", "4000", "10000", ["Umber", "Kelp"]), []),
    (movie_line("Solo Ridge", "1988-08-08", "3", "1", ["Umber"]), [None]),
    (movie_line("Solo Ridge", "1988-08-08", "3", "1", ["Umber"]), []),
]
# one row for each way to be dropped
DROPPED_LINES = [
    movie_line("Basalt", "1980-01-01", "n/a", "100"),
    movie_line("Basalt", "1980-01-01", "100", ""),
    movie_line("Basalt", "1980-01-01", "0", "100"),
    movie_line("Basalt", "1980-01-01", "100", "-100"),
    movie_line("", "1980-01-01", "100", "100"),
]
MOVIE_LINES = [line for line, _ in CASES] + DROPPED_LINES
MOVIES = len(CASES)

# the last one's title no movie has
ARTICLE_URLS = [
    "Basalt", "Basalt_(film)", "Basalt_(1980_film)", "Copper_Tide_(film)", "Copper_Tide_(1994_film)", "copper_tide_(1994_film)", "Lamp_Post_(1999_film)",
    "Lamp_Post_(film)", "Quarry_Road_(TV_series)", "Twelve_Kites", "Twelve_Kites_(album)", "Vesper_&_Co", "Nowhere_Else_(1994_film)",
]
WANTED_URLS = ARTICLE_URLS[:-1]


def article_doc(last):
    url, name = escape(f"https://en.example.org/wiki/{last}"), escape(last.replace("_", " "))
    sublinks = "".join(f'<sublink linktype="nav"><anchor>{a}</anchor><link>{url}#{a}</link></sublink>' for a in ("Plot", "Cast", "Notes"))
    return f"<doc>\n<title>Article: {name}</title><url>{url}</url>\n<abstract>{name}\n in short</abstract><links>{sublinks}</links>\n</doc>\n"


def _written(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def write_movies(folder, lines=None):
    return _written(folder, "movies.csv", "\n".join([MOVIE_HEADER, *(MOVIE_LINES if lines is None else lines)]) + "\n")


def write_articles(folder, urls=None, name="articles.xml"):
    return _written(folder, name, "<feed>\n" + "".join(map(article_doc, ARTICLE_URLS if urls is None else urls)) + "</feed>\n")


# Derived by hand: (title, year, revenue_to_budget, url end) of every result row.
GOLDEN = Counter(
    {
        ("Basalt", "1980", 9.0, "Basalt_(1980_film)"): 1,
        ("Quarry Road", "1967", 8.33, None): 1,
        ("Copper Tide", "1994", 3.5, "Copper_Tide_(1994_film)"): 2,
        ("Copper Tide", "1994", 3.5, "copper_tide_(1994_film)"): 2,
        ("Vesper & Co", "2003", 3.0, "Vesper_&_Co"): 1,
        ("Twelve Kites", "2010", 2.5, "Twelve_Kites"): 1,
        ("Copper Tide", None, 1.25, "Copper_Tide_(film)"): 1,
        ("Basalt", "1979", 0.75, "Basalt_(film)"): 1,
        (" LAMP Post ", "1999", 0.5, "Lamp_Post_(1999_film)"): 1,
        ("Solo Ridge", "1988", 0.33, None): 1,
    }
)


def results(df):
    """The rows of a result in the form of ``GOLDEN``."""
    return Counter((r.title, r.year, r.revenue_to_budget, r.url.rsplit("/", 1)[-1] if r.url else None) for r in df.collect())
