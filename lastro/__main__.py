"""Runs one step of the refresh: ``python -m lastro``, or ``spark-submit`` this
file with the package on the path (``--py-files``).

    ingest FOLDER               add the files of a delivery to bronze
    load FOLDER                 add the files not loaded yet, put wrong ones aside,
                                print what became of each, note their quality
    arrivals FOLDER --log DIR   add the files that are new since the last run
    check --output DIR          write the quality checks on bronze
    refresh                     rebuild silver and gold from bronze
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from lastro import operators, plans, sources, streaming
from lastro.names import ID, NAME, Layers
from lastro.plans.silver import negative_age, parsed_values, validity_rules


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="lastro", description=__doc__,
        formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["ingest", "load", "arrivals", "check", "refresh"])
    parser.add_argument("folder", nargs="?", help="where the CSV files are")
    parser.add_argument("--log", help="where arrivals remembers loaded files")
    parser.add_argument("--catalog")
    parser.add_argument("--bronze", default=Layers.bronze_schema)
    parser.add_argument("--silver", default=Layers.silver_schema)
    parser.add_argument("--gold", default=Layers.gold_schema)
    parser.add_argument("--format", help="table format; the session's by default")
    parser.add_argument("--money", default="float",
                        help="type of amounts, such as decimal(18,2)")
    parser.add_argument("--strip-whitespace", action="store_true")
    parser.add_argument("--on-error", choices=["null", "fail"], default="null")
    parser.add_argument("--multiline", action="store_true",
                        help="quoted values may hold line ends; files do not split")
    parser.add_argument("--corrupt-apart", action="store_true",
                        help="keep rows of broken lines out of silver")
    parser.add_argument("--key", help="column that tells clients apart, for refresh, "
                        "or that should be unique, for check")
    parser.add_argument("--where", help="SQL condition on the rows that gold counts")
    parser.add_argument("--distinct-clients", action="store_true")
    parser.add_argument("--multiplier", type=float, default=plans.RISK_MULTIPLIER,
                        help="of the mean, above which an amount is a risk")
    parser.add_argument("--rule", help="SQL condition that check takes for a "
                        "violation; a negative age by default")
    parser.add_argument("--load-changed", action="store_true",
                        help="load files whose path was loaded with other lines")
    parser.add_argument("--together", action="store_true",
                        help="refresh replaces all tables of silver and gold at one "
                        "moment; they become views")
    parser.add_argument("--output", help="where check writes the rows it finds")
    parser.add_argument("--report", action="store_true",
                        help="after refresh, print the quality of the raw rows")
    args = parser.parse_args(argv)
    if args.step in ("ingest", "load", "arrivals") and not args.folder:
        parser.error(f"{args.step} needs a folder")
    if args.step == "arrivals" and not args.log:
        parser.error("arrivals needs --log")
    if args.step == "check" and not args.output:
        parser.error("check needs --output")
    return args


def check(spark: SparkSession, layers: Layers, output: str, key: str = ID,
          rule: str | None = None) -> dict:
    """Writes all duplicates and violations, and returns the totals.

    Bronze is read three times: for its keys, for the rows of repeated keys,
    and once for violations and profile together.
    """
    bronze = sources.scan(spark, layers.bronze)
    operators.duplicates(bronze, key).write.mode("overwrite").parquet(
        f"{output}/duplicatas")
    report = Observation()
    broken = negative_age(bronze) if rule is None else F.expr(rule)
    observed = bronze.observe(report, *operators.quality_metrics(
        bronze.columns, parsed_values(), validity_rules(bronze)))
    (operators.violations(observed, broken).write.mode("overwrite")
     .parquet(f"{output}/violacoes"))
    found = report.get
    rows = found["total_linhas"]
    totals = {label: spark.read.parquet(f"{output}/{label}").count()
              for label in ("duplicatas", "violacoes")}
    percent = {f"percentual_{c}": round(100 * found[f"nulos_{c}"] / rows, 2)
               if rows else None for c in bronze.columns}
    return {**totals, **found, **percent}


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    layers = Layers(args.bronze, args.silver, args.gold, args.catalog)
    csv = {"multiLine": "true"} if args.multiline else {}
    if args.step in ("ingest", "load", "arrivals"):
        sources.ensure_schema(spark, layers.schema(layers.bronze_schema))
    if args.step == "ingest":
        sources.append_history(
            spark, args.folder, layers.bronze, fmt=args.format, **csv)
    elif args.step == "load":
        found = sources.load_deliveries(
            spark, args.folder, layers.bronze, layers.ledger, fmt=args.format,
            load_changed=args.load_changed, **csv)
        for row in found.orderBy("arquivo").toLocalIterator():
            print(json.dumps(row.asDict(), ensure_ascii=False))
        plans.profile_loads(spark, layers)
    elif args.step == "arrivals":
        streaming.ingest_arrivals(
            spark, args.folder, layers.bronze, args.log, fmt=args.format, **csv)
    elif args.step == "check":
        found = check(spark, layers, args.output, args.key or ID, args.rule)
        print(json.dumps(found, indent=2))
    else:
        refresh = plans.refresh_together if args.together else plans.refresh
        fmt = {"fmt": args.format} if args.format or not args.together else {}
        report = refresh(
            spark, layers, **fmt, money_type=args.money,
            strip_whitespace=args.strip_whitespace, on_error=args.on_error,
            multiplier=args.multiplier, key=args.key or NAME,
            where=F.expr(args.where) if args.where else None,
            distinct_clients=args.distinct_clients, corrupt_apart=args.corrupt_apart)
        if args.report:
            print(json.dumps(report.get, indent=2))


if __name__ == "__main__":
    asked = arguments()
    run(SparkSession.builder.appName("lastro").getOrCreate(), asked)
