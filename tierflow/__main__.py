"""Batch entry point, for ``python -m tierflow`` or ``spark-submit``."""

from __future__ import annotations

import argparse

from tierflow.operators.quality import POLICIES
from tierflow.plans.config import LayerConfig
from tierflow.plans.run import create_layers, run
from tierflow.runtime import build_session, clear_scratch
from tierflow.sinks import maintenance
from tierflow.sinks.lake import Lake


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierflow")
    parser.add_argument("--lake", required=True, help="root folder of the published tables")
    parser.add_argument("--database", default="lake", help="catalog database for the views")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("create", help="publish empty layer tables")
    job = commands.add_parser("run", help="raw JSON logs to bronze, silver, rfm and gold")
    job.add_argument("--raw", required=True, help="folder or glob of the JSON logs")
    job.add_argument("--report-date", required=True, help="yyyyMMdd or yyyy-MM-dd")
    job.add_argument("--total-days", type=int, help="length of the period; default: counted from the data")
    job.add_argument("--policy", choices=POLICIES, default="fail")
    job.add_argument("--population", choices=("all", "usable"), default="all")
    clean = commands.add_parser("vacuum", help="remove the files of expired snapshots")
    clean.add_argument("table")
    clean.add_argument("--retention-days", type=float, default=7)
    chosen = parser.parse_args(arguments)

    spark = build_session("tierflow")
    lake = Lake(spark, chosen.lake, chosen.database)
    if chosen.command == "create":
        create_layers(lake)
    elif chosen.command == "vacuum":
        maintenance.vacuum(lake, chosen.table, chosen.retention_days)
    else:
        config = LayerConfig(
            report_date=chosen.report_date, total_days=chosen.total_days, policy=chosen.policy,
            population=chosen.population,
        )
        try:
            run(lake, chosen.raw, config)
        finally:
            clear_scratch(spark)


if __name__ == "__main__":
    main()
