"""Command line: build the warehouse from landed files, write every layer
and run the data-quality suites.

    python -m marquee.cli --movies movies_main.csv --extended movie_extended.csv \\
        --ratings ratings.json --benchmark external_benchmark.csv --out /data/warehouse
"""

from __future__ import annotations

import argparse
import json

from marquee.config import MIN_BUDGET, MIN_REVENUE, Scope


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    ap.add_argument("--movies", required=True)
    ap.add_argument("--extended", required=True)
    ap.add_argument("--ratings", required=True)
    ap.add_argument("--benchmark", required=True)
    ap.add_argument("--out", required=True, help="target folder for the layer tables")
    ap.add_argument("--ratings-json-lines", action="store_true", help="ratings file is JSON lines")
    ap.add_argument("--one-line-records", action="store_true", help="CSV fields hold no line breaks")
    ap.add_argument("--min-budget", type=float, default=MIN_BUDGET)
    ap.add_argument("--min-revenue", type=float, default=MIN_REVENUE)
    ap.add_argument("--title-mode", choices=["intent", "as_written"], default="intent")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from marquee.plans.quality_suite import business_rule_suite, cleaning_count_checks, schema_suite
    from marquee.plans.warehouse import Warehouse
    from marquee.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    ensure_checkpoint_dir(spark)
    w = Warehouse.from_files(spark, args.movies, args.extended, args.ratings, args.benchmark,
                             ratings_top_level_array=not args.ratings_json_lines,
                             multiline=not args.one_line_records,
                             scope=Scope(args.min_budget, args.min_revenue), title_mode=args.title_mode)
    paths = w.write_all(args.out)
    out = args.out.rstrip("/")
    models = w.written(paths)  # what readers will get, and no plan runs twice
    tests = schema_suite(models).unionByName(business_rule_suite(models, w.scope))
    tests.write.mode("overwrite").parquet(f"{out}/tests/results")
    cleaning_count_checks(models["silver_movies"], models["silver_ratings"], models["silver_extended"]) \
        .write.mode("overwrite").parquet(f"{out}/tests/count_checks")
    failed = spark.read.parquet(f"{out}/tests/results").where("status <> 'pass'").count()
    print(json.dumps({"tables": len(paths), "failed_tests": failed, "out": out}))
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
