"""Run the jobs: ``python -m tagloom load|preview|analyse --help``, or through spark-submit."""

import argparse

from pyspark.sql import SparkSession

from tagloom import schemas
from tagloom.plans.analysis import run_analysis
from tagloom.plans.etl import run_etl
from tagloom.sources.lake import Lake


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tagloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="load CSV exports into the lake")
    load.add_argument("--posts", nargs="+", required=True)
    load.add_argument("--comments", nargs="+", required=True)
    load.add_argument("--synonyms", nargs="+", required=True)
    load.add_argument("--incremental", action="store_true", help="upsert by Id; default: overwrite")
    load.add_argument("--rejects", help="folder for records that do not fit; default: such a record fails the load")
    preview = jobs.add_parser("preview", help="print the first rows of each lake table")
    preview.add_argument("--rows", type=int, default=100)
    analyse = jobs.add_parser("analyse", help="write the result tables as CSV folders")
    analyse.add_argument("--output", required=True)
    analyse.add_argument("--replace", action="store_true", help="overwrite earlier results")
    for job in (load, preview, analyse):
        job.add_argument("--lake", required=True, help="root folder of the lake")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = (SparkSession.builder.appName(f"tagloom {args.job}")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    lake = Lake(spark, args.lake)
    if args.job == "load":
        run_etl(spark, lake, args.posts, args.comments, args.synonyms, args.incremental,
                rejects=args.rejects).show()
    elif args.job == "preview":
        for name in (schemas.QUESTIONS_TABLE, schemas.ANSWERS_TABLE, schemas.COMMENTS_TABLE):
            lake.preview(name, args.rows)
    else:
        run_analysis(lake, args.output, "overwrite" if args.replace else "errorifexists")


if __name__ == "__main__":
    main()
