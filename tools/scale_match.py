"""Both match forms with a larger article side: one article per ``lineitem``
row (URL built from its part's name and brand, so ~30 articles per title),
movies from the ``part`` view.  Times each form with the noop sink and
checks that both return the same number of rows.

usage: python tools/scale_match.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from titlematch.operators.match import tiered_match, tiered_match_except  # noqa: E402
from titlematch.plans import catalogue as cat  # noqa: E402
from titlematch.plans.prepare import prepare_articles  # noqa: E402
from titlematch.session import local_session  # noqa: E402


def lineitem_articles(part, lineitem):
    j = lineitem.select("l_partkey", "l_linenumber", "l_orderkey").join(
        part.select("p_partkey", "p_name", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )
    year = (F.lit(1995) + F.col("p_partkey") % 7).cast("string")
    suffix = (
        F.when(F.col("l_linenumber") % 6 == 0, F.concat(F.lit("_("), year, F.lit("_film)")))
        .when(F.col("l_linenumber") % 6 == 1, F.lit("_(film)"))
        .when(F.col("l_linenumber") % 6 == 2, F.lit(""))
        .when(F.col("l_linenumber") % 6 == 3, F.lit("_(comics)"))
        .otherwise(F.lit("_(1997)"))
    )
    raw = j.select(
        F.concat(F.lit("Article: "), "p_name").alias("title"),
        F.concat(
            F.lit("https://w.example/wiki/"), F.regexp_replace(F.concat_ws(" ", "p_name", "p_brand"), " ", "_"), suffix
        ).alias("url"),
        F.concat_ws(" ", "p_type", F.col("l_orderkey").cast("string")).alias("abstract"),
    )
    return prepare_articles(raw)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    part = cat._table(spark, sf, "part")
    lineitem = cat._table(spark, sf, "lineitem")
    print("articles", lineitem_articles(part, lineitem).count())
    for rnd in range(2):
        for name, fn in [("single_pass", tiered_match), ("three_join", tiered_match_except)]:
            t0 = time.perf_counter()
            fn(cat.movies(spark, sf, part), lineitem_articles(part, lineitem)).write.format("noop").mode(
                "overwrite"
            ).save()
            print(rnd, name, round(time.perf_counter() - t0, 2))
    n1 = tiered_match(cat.movies(spark, sf, part), lineitem_articles(part, lineitem)).count()
    n2 = tiered_match_except(cat.movies(spark, sf, part), lineitem_articles(part, lineitem)).count()
    print("rows", n1, n2)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
