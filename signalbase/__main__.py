"""Command line: load a landing folder into the tables and export the report tabs."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from . import fixed, schemas
from .plans.run import run
from .session import build_session, drop_stages
from .sinks.export import export_tabs
from .sinks.tables import read_table
from .sources.landing import load_landing


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m signalbase", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder with one sub-folder per source")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--export", help="folder for the CSV tabs; none are written without it")
    parser.add_argument("--export-files", type=int, help="CSV files per tab; default: written in parallel, as many as partitions")
    parser.add_argument("--quarantine", required=True, help="folder for rows that break the contract")
    parser.add_argument("--run-time", type=datetime.fromisoformat, default=None, help="run time; default is now")
    parser.add_argument("--hours", type=int, default=fixed.FRESH_HOURS, help="greatest age of jobs and news")
    parser.add_argument("--target", type=int, default=0, help="rows per run and source; the default 0 takes all")
    parser.add_argument("--lines", action="store_true", help="JSON sources hold one document per line")
    parser.add_argument("--run-id", help="name of the run; a run of that name is loaded once, however often it is repeated")
    args = parser.parse_args(argv)

    spark = build_session()
    landed = load_landing(spark, args.landing, args.quarantine, args.lines)
    counts = run(spark, landed, args.tables, args.run_time or datetime.now(timezone.utc), args.hours,
                 args.target or None, quarantine=args.quarantine, run_id=args.run_id)
    for row in counts.collect():
        print(f"{row['table']}: {row['rows']} rows")
    if args.export:
        export_tabs({name: read_table(spark, args.tables, name) for name in schemas.TABLES}, args.export,
                    args.export_files)
    drop_stages(spark)


if __name__ == "__main__":
    main()
