"""Movie- and article-shaped views derived in SQL from the ``part`` table.

The text is shared by Spark (``{part}`` bound to a DataFrame) and DuckDB
(``part`` a registered view), so both engines see identical inputs.  Values
are strings like the raw sources; numbers are never fractional, because the
engines round fractional casts differently.
"""

from __future__ import annotations

from titlematch.plans.sql import escape_braces

# The view definitions both engines run.
MOVIE_VIEW = """
SELECT p_partkey AS id,
       concat(p_name, ' ', p_brand) AS title,
       concat(CAST(1995 + p_partkey % 7 AS VARCHAR(10)), '-06-15') AS release_date,
       CASE WHEN p_partkey % 13 = 0 THEN 'n/a' WHEN p_partkey % 11 = 0 THEN '0'
            ELSE CAST(p_size * 1000 AS VARCHAR(20)) END AS budget,
       CAST((p_partkey * 977) % 500000 AS VARCHAR(20)) AS revenue,
       CAST(p_partkey % 10 AS VARCHAR(10)) AS vote_average,
       CASE WHEN p_partkey % 17 = 0 THEN '[]'
            ELSE concat('[{"id": ', CAST(p_size AS VARCHAR(10)), ', "name": "', p_type, '"}, {"id": 1, "name": "', p_name, '"}]') END AS genres,
       concat('[{"name": "', p_brand, '", "id": ', CAST(p_size AS VARCHAR(10)), '}]') AS production_companies
FROM {part}
"""

ARTICLE_VIEW = """
SELECT concat('Article: ', p_name) AS title,
       concat('https://w.example/wiki/', replace(concat(p_name, ' ', p_brand), ' ', '_'),
              CASE p_partkey % 6 WHEN 0 THEN concat('_(', CAST(1995 + p_partkey % 7 AS VARCHAR(10)), '_film)')
                                 WHEN 1 THEN '_(film)' WHEN 2 THEN '' WHEN 3 THEN '_(comics)'
                                 WHEN 4 THEN '_(1996_musical)' ELSE '_(1997)' END) AS url,
       p_type AS abstract
FROM {part}
"""


def for_duckdb(view_sql: str) -> str:
    return view_sql.replace("{part}", "part")


def for_spark(view_sql: str) -> str:
    """Only ``{part}`` is a DataFrame placeholder."""
    return escape_braces(view_sql, ["part"])
