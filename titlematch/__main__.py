"""``spark-submit titlematch/__main__.py <movies> <articles> [options]`` or
``python -m titlematch <movies> <articles> [options]``.

Runs the batch job on the session the launcher provides (master, memory and
``spark.checkpoint.dir`` come from spark-submit / spark-defaults).
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from titlematch.plans.job import RESULT_ROWS, run  # noqa: E402
from titlematch.sinks import ParquetTarget, TableTarget  # noqa: E402
from titlematch.sources import JdbcTarget  # noqa: E402


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="titlematch", description="Link movies to articles and write the top rows.")
    p.add_argument("movies", help="movie CSV file or folder")
    p.add_argument("articles", help="article XML dump file or folder")
    out = p.add_mutually_exclusive_group()
    out.add_argument("--parquet", help="write the result as Parquet to this path")
    out.add_argument("--table", help="write the result to this catalog table")
    out.add_argument("--jdbc-table", help="write to this JDBC table; connection from POSTGRES_* variables")
    p.add_argument("--rows", type=int, default=RESULT_ROWS, help="rows to keep (default 1000; -1 for all)")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--native-xml", action="store_true", help="use the built-in (non-splitting) XML reader")
    p.add_argument("--lexed-xml", action="store_true", help="lex the dump across its splits (row tag in comments, CDATA or nested)")
    p.add_argument("--partitioned", action="store_true", help="lay the staged tables out by title before the match")
    p.add_argument("--keep-stage", action="store_true", help="keep the staged Parquet tables")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName("titlematch").getOrCreate()
    table = None
    if args.jdbc_table:
        target, table = JdbcTarget.from_env(), args.jdbc_table
    elif args.table:
        target = TableTarget(args.table)
    else:
        target = ParquetTarget(args.parquet or "titlematch_result")
    res = run(
        spark,
        args.movies,
        args.articles,
        target,
        table=table,
        rows=None if args.rows < 0 else args.rows,
        mode=args.mode,
        splittable_xml=not args.native_xml,
        keep_stage=args.keep_stage,
        partitioned=args.partitioned,
        lexed_xml=args.lexed_xml,
    )
    print(json.dumps(res.__dict__))
    return 0


if __name__ == "__main__":
    sys.exit(main())
