"""The batch run as a command: ``python -m changewatch`` or, on a cluster, ``spark-submit`` of this file."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from changewatch.config import Settings
from changewatch.plans import job
from changewatch.sources import readers


def pair(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def parser() -> argparse.ArgumentParser:
    own = argparse.ArgumentParser(prog="changewatch", description="Write all review reports.")
    source = own.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="folder with one Parquet table each")
    source.add_argument("--jdbc", help="address of a SQL database")
    own.add_argument("--property", type=pair, action="append", default=[], metavar="NAME=VALUE", help="of the connection")
    own.add_argument("--bounds", type=pair, action="append", default=[], metavar="TABLE=LOW:HIGH",
                     help="key range of a database table that is read in parallel")
    own.add_argument("--namespaces", help="namespace names, JSON")
    own.add_argument("--request-links", help="links of the request page, JSON")
    own.add_argument("--item-usage", help="item usage, tab-separated")
    own.add_argument("--as-of", required=True, type=datetime.fromisoformat, help="the time that reports take as now")
    own.add_argument("--work", help="shared folder for intermediate tables, if spark.checkpoint.dir isn't set")
    own.add_argument("--out", required=True, help="folder of the reports")
    return own


def tables(spark: SparkSession, options: argparse.Namespace) -> readers.Tables:
    """Base tables from Parquet or a database, dimensions from files where they are named."""
    if options.parquet:
        base = readers.from_parquet(spark, options.parquet)
    else:
        bounds = {name: tuple(map(int, value.split(":"))) for name, value in options.bounds}
        base = readers.from_jdbc(spark, options.jdbc, dict(options.property), bounds)
    files = {"namespaces": (readers.read_namespaces, options.namespaces),
             "request_links": (readers.read_request_links, options.request_links),
             "entity_usage": (readers.read_entity_usage, options.item_usage)}
    return base.replaced({name: lambda read=read, path=path: read(spark, path)
                          for name, (read, path) in files.items() if path})


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("changewatch").getOrCreate()
    job.run(spark, tables(spark, options), Settings(as_of=options.as_of), options.out, options.work)


if __name__ == "__main__":
    main()
