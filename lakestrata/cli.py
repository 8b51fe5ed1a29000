"""The jobs as commands: `spark-submit --py-files lakestrata.zip run_job.py <job> ...`."""

from __future__ import annotations

import argparse
import datetime
import json
from collections.abc import Sequence

from lakestrata import plans
from lakestrata.session import get_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakestrata")
    jobs = parser.add_subparsers(dest="job", required=True)

    clean = jobs.add_parser("clean-source", help="clean one delimited source into parquet")
    clean.add_argument("--table", required=True)
    clean.add_argument("--source", required=True)
    clean.add_argument("--target", required=True)
    clean.add_argument("--report", required=True)
    clean.add_argument("--run-date", type=datetime.date.fromisoformat, required=True)
    clean.add_argument("--separator")
    clean.add_argument("--encoding")
    clean.add_argument("--entity-column")
    clean.add_argument("--schema", help="DDL of the raw columns; inferred if left out")
    clean.add_argument("--no-infer", action="store_true", help="keep every column as text")
    clean.add_argument("--text-columns", nargs="*", help="normalised names of columns that stay text")
    clean.add_argument("--legacy-upper-o", action="store_true", help="fold an accented o to O in headers")
    clean.add_argument("--on-failure", choices=["record", "raise"], default="record")

    table = jobs.add_parser("delivery-table", help="aggregate and join the cleaned sources")
    for name in ("--complaints", "--employees", "--banks", "--target"):
        table.add_argument(name, required=True)

    route = jobs.add_parser("route", help="split raw trip files by category")
    route.add_argument("--source", required=True)
    route.add_argument("--target", required=True)
    route.add_argument("--all-categories", action="store_true", help="every category and year")

    silver = jobs.add_parser("silver", help="conform the trips of one colour")
    silver.add_argument("--colour", choices=sorted(plans.SILVER), required=True)
    silver.add_argument("--source", required=True)
    silver.add_argument("--target", required=True)
    silver.add_argument("--from-raw", action="store_true", help="the source is not routed yet")

    silver.add_argument("--clustered", action="store_true", help="write without a shuffle")
    silver.add_argument("--years", type=int, nargs=2, metavar=("FIRST", "LAST"), help="of raw files")
    silver.add_argument("--schema", help="DDL of the source columns; read from the files if left out")

    gold = jobs.add_parser("gold", help="unite the silver trips")
    for name in ("--yellow", "--green", "--target"):
        gold.add_argument(name, required=True)

    for name, text in (
        ("export-jdbc", "replace a database table by a dataset"),
        ("deliver", "load the delivery table"),
    ):
        load = jobs.add_parser(name, help=text)
        load.add_argument("--source", required=True)
        load.add_argument("--url", required=True)
        load.add_argument("--table", required=True)
        load.add_argument("--properties", required=True, help="JSON file: user, password, driver")
        load.add_argument("--connections", type=int)
        load.add_argument("--truncate", action="store_true", help="keep a replaced table's definition and key")
        if name == "deliver":
            load.add_argument("--variant", choices=["append", "replace"], default="append")

    files = jobs.add_parser("deliver-files", help="load the delivery table of files, each load once")
    for name in ("--source", "--target", "--load-id"):
        files.add_argument(name, required=True)
    files.add_argument("--variant", choices=["append", "replace", "create"], default="append")

    land = jobs.add_parser("land-new", help="land files that are new or have changed")
    for name in ("--source", "--target"):
        land.add_argument(name, required=True)
    land.add_argument("--glob", default="*")
    return parser


def _properties(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = get_session(f"lakestrata {args.job}")
    if args.job == "clean-source":
        plans.clean_source_job(
            spark,
            args.source,
            args.target,
            args.report,
            args.run_date,
            table=args.table,
            separator=args.separator,
            encoding=args.encoding,
            entity_column=args.entity_column,
            schema=args.schema,
            infer=not args.no_infer,
            on_failure=args.on_failure,
            legacy_upper_o=args.legacy_upper_o,
            **({} if args.text_columns is None else {"text_columns": args.text_columns}),
        )
    elif args.job == "delivery-table":
        plans.delivery_table_job(spark, args.complaints, args.employees, args.banks, args.target)
    elif args.job == "route":
        chosen = (plans.ROUTES, None) if args.all_categories else (plans.SILVER_ROUTES, plans.SILVER_YEARS)
        plans.route_job(spark, args.source, args.target, *chosen)
    elif args.job == "silver":
        plans.silver_job(
            spark, args.colour, args.source, args.target, from_raw=args.from_raw,
            clustered=args.clustered, schema=args.schema,
            years=plans.SILVER_YEARS if args.years is None else tuple(args.years),
        )
    elif args.job == "gold":
        plans.gold_job(spark, {"yellow": args.yellow, "green": args.green}, args.target)
    elif args.job == "deliver-files":
        plans.deliver_files_job(spark, args.source, args.target, args.load_id, variant=args.variant)
    elif args.job == "land-new":
        plans.land_new_job(spark, args.source, args.target, args.glob)
    elif args.job == "export-jdbc":
        plans.export_jdbc_job(
            spark, args.source, args.url, args.table, _properties(args.properties),
            connections=args.connections, truncate=args.truncate,
        )
    else:
        plans.deliver_job(
            spark, args.source, args.url, args.table, _properties(args.properties),
            variant=args.variant, connections=args.connections, truncate=args.truncate,
        )
