"""Write the final physical plans of the key queries to PLANS.md: each frame
is executed, and the adaptive plan of that execution is printed.

usage: python tools/explain.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from titlematch.operators.match import tiered_match  # noqa: E402
from titlematch.plans.catalogue import QUERIES, articles, movies  # noqa: E402
from titlematch.plans.job import ranked, staged_sources  # noqa: E402
from titlematch.session import local_session  # noqa: E402

WIDTH = 150


def final_plan(df) -> str:
    """The plan ``df`` ran with, long lines cut."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = buf.getvalue().strip().splitlines()
    if not any("isFinalPlan=true" in line for line in lines):
        if any("AdaptiveSparkPlan" in line for line in lines):
            raise RuntimeError("the plan shown is not the final one")
    ends = [i for i, line in enumerate(lines) if "== Initial Plan ==" in line]
    kept = lines[: ends[0]] if ends else lines
    return "\n".join(line if len(line) <= WIDTH else line[:WIDTH] + " ..." for line in kept)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "PLANS.md"
    spark = local_session()
    spark.conf.set("spark.sql.debug.maxToStringFields", "8")
    scratch = tempfile.mkdtemp(prefix="titlematch-explain-", dir="/tmp")
    m, a, _, _ = staged_sources(movies(spark, sf), articles(spark, sf), scratch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = tiered_match(m, a)
    shuffled_plan = final_plan(shuffled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    sections = [
        ("The job's match and top rows, on its staged tables", final_plan(ranked(tiered_match(m, a)))),
        ("The same match with broadcasts off", shuffled_plan),
        ("`url_parse` on the driver views", final_plan(QUERIES["url_parse"](spark, sf))),
        ("`first_seen_companies`", final_plan(QUERIES["first_seen_companies"](spark, sf))),
    ]
    with open(out, "w") as f:
        f.write(f"# Physical plans\n\nWritten by `tools/explain.py` at {sf}: the final adaptive plan of each executed frame.\n\n")
        for title, plan in sections:
            f.write(f"## {title}\n\n```\n{plan}\n```\n\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
