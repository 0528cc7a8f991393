"""The loads from a command line, for ``spark-submit`` or ``python -m lineledger``.

    python -m lineledger backfill --parquet /data/operational --table mart --start 2025-01-01 --end 2025-08-01
    python -m lineledger daily --catalog operational --table mart --day 2025-09-09 --compact
    python -m lineledger daily --jdbc jdbc:mysql://host/db --jdbc-options login.json --source-bytes 5000000000000 \\
        --split documents=document_id:1:900000000:64 --split documents_tabular_part=document_id:1:900000000:400 \\
        --table mart --day 2025-09-09 --sink-jdbc jdbc:clickhouse://host/db --sink-table mart --sink-options sink.json
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Sequence
from dataclasses import fields
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lineledger.config import MartConfig
from lineledger.functions import as_day
from lineledger.plans import run_backfill, run_daily
from lineledger.sinks import append_database
from lineledger.sources import Reader, catalog_reader, database_reader, load_sources, parquet_reader


def _split(text: str) -> tuple[str, dict[str, Any]]:
    """``table=column:lowest:highest:parts``."""
    table, _, rest = text.partition("=")
    try:
        column, lowest, highest, parts = rest.split(":")
        return table, {"partition_column": column, "bounds": (int(lowest), int(highest)), "num_partitions": int(parts)}
    except ValueError:
        raise argparse.ArgumentTypeError(f"not table=column:lowest:highest:parts: {text}") from None


def _json(path: str) -> dict[str, Any]:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def _config(path: str) -> MartConfig:
    """Settings of the mart from a JSON file; lists become tuples."""
    values = _json(path)
    if unknown := set(values) - {f.name for f in fields(MartConfig)}:
        raise argparse.ArgumentTypeError(f"unknown settings: {', '.join(sorted(unknown))}")
    return MartConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def _arguments() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    source = common.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", metavar="FOLDER", help="folder with one parquet table per source")
    source.add_argument("--catalog", metavar="SCHEMA", help="schema of the session catalog with the sources")
    source.add_argument("--jdbc", metavar="URL", help="database with the sources; needs --split and --source-bytes")
    common.add_argument("--jdbc-options", type=_json, metavar="FILE", help="JSON file with user, password, driver, ...")
    common.add_argument(
        "--split", type=_split, action="append", default=[], metavar="TABLE=COLUMN:LOWEST:HIGHEST:PARTS",
        help="how a database table is read in parallel; required for documents and documents_tabular_part",
    )
    common.add_argument("--source-bytes", type=int, help="size of the largest source table, if files do not tell it")
    common.add_argument("--config", type=_config, default=MartConfig(), metavar="FILE", help="JSON file with settings")
    common.add_argument("--table", required=True, help="mart table; created if it does not exist")
    common.add_argument("--location", help="where to create the table")
    common.add_argument("--sink-jdbc", metavar="URL", help="database that gets the loaded rows as well")
    common.add_argument("--sink-table", help="its table")
    common.add_argument("--sink-options", type=_json, metavar="FILE", help="JSON file with user, password, driver, ...")
    common.add_argument("--sink-connections", type=int, default=8)

    parser = argparse.ArgumentParser(prog="lineledger")
    jobs = parser.add_subparsers(dest="job", required=True)
    backfill = jobs.add_parser("backfill", parents=[common], help="load the days from start up to, not including, end")
    backfill.add_argument("--start", type=as_day, required=True)
    backfill.add_argument("--end", type=as_day, required=True)
    backfill.add_argument("--mode", choices=["replace", "append"], default="replace")
    daily = jobs.add_parser("daily", parents=[common], help="replace one day")
    daily.add_argument("--day", type=as_day, required=True)
    daily.add_argument("--compact", action="store_true")
    return parser


def _reader(options: argparse.Namespace) -> Reader:
    if options.parquet:
        return parquet_reader(options.parquet)
    if options.catalog:
        return catalog_reader(options.catalog)
    return database_reader(options.jdbc, options.jdbc_options, dict(options.split))


def _sink(options: argparse.Namespace) -> Callable[[DataFrame], None] | None:
    if options.sink_jdbc is None:
        return None
    to = {"url": options.sink_jdbc, "properties": options.sink_options, "connections": options.sink_connections}
    return lambda rows: append_database(rows, options.sink_table, **to)


def main(argv: Sequence[str] | None = None) -> None:
    parser = _arguments()
    options = parser.parse_args(argv)
    if (options.sink_jdbc is None) != (options.sink_table is None):
        parser.error("--sink-jdbc and --sink-table go together")
    if options.jdbc and options.source_bytes is None:
        parser.error("--jdbc needs --source-bytes: a database does not tell Spark how large its tables are")
    try:
        reader = _reader(options)
    except ValueError as error:
        parser.error(str(error))
    spark = SparkSession.builder.appName(f"lineledger {options.job}").getOrCreate()
    sources = load_sources(spark, reader)
    shared = {
        "config": options.config,
        "location": options.location,
        "source_bytes": options.source_bytes,
        "sink": _sink(options),
    }
    if options.job == "backfill":
        run_backfill(spark, sources, options.table, options.start, options.end, mode=options.mode, **shared)
    else:
        run_daily(spark, sources, options.table, options.day, compact=options.compact, **shared)


if __name__ == "__main__":
    main()
