"""Command line: ``python -m starloom load|lookups ...`` (or through ``spark-submit``)."""

from __future__ import annotations

import argparse

from starloom import plans
from starloom.session import build_session


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="raw files to star tables")
    load.add_argument("--songs", required=True, help="folder of catalogue files")
    load.add_argument("--events", required=True, help="folder of log files")
    load.add_argument("--output", required=True, help="folder of the star tables")
    load.add_argument("--profile", required=True, choices=sorted(plans.PROFILES))
    load.add_argument("--songs-format", default="json", choices=["json", "csv", "parquet"])
    load.add_argument("--events-format", default="json", choices=["json", "csv", "parquet"])
    load.add_argument("--songs-glob", help="only catalogue files whose names match")
    load.add_argument("--events-glob", help="only log files whose names match")
    load.add_argument("--events-json-paths", help="mapping file for the log's fields")
    load.add_argument("--on-reject", default="quarantine", choices=["quarantine", "fail"])

    lookups = commands.add_parser("lookups", help="CSV logs to lookup tables")
    lookups.add_argument("--events", required=True, help="folder of CSV files")
    lookups.add_argument("--output", required=True, help="folder of the lookup tables")
    for command in (load, lookups):
        command.add_argument("--plain-csv", action="store_true", help="no CSV field holds a line break")
    return parser.parse_args()


def main() -> None:
    chosen = arguments()
    spark = build_session()
    if chosen.command == "load":
        sources = plans.Sources(
            chosen.songs,
            chosen.events,
            songs_format=chosen.songs_format,
            events_format=chosen.events_format,
            songs_glob=chosen.songs_glob,
            events_glob=chosen.events_glob,
            events_json_paths=chosen.events_json_paths,
            quoted_newlines=not chosen.plain_csv,
            on_reject=chosen.on_reject,
        )
        plans.run(spark, sources, chosen.output, plans.PROFILES[chosen.profile])
    else:
        staged = plans.stage_listens(
            spark, chosen.events, f"{chosen.output}/_staging", quoted_newlines=not chosen.plain_csv
        )
        plans.load_lookups(staged, chosen.output, ["sessionId", "itemInSession"])


if __name__ == "__main__":
    main()
