"""What the jobs share: their settings, their log and their command line."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.session import session, ship

LOG = logging.getLogger("jobs")
T = TypeVar("T")

#: What stands for a name that is null or empty: such a value can't name a partition.
UNNAMED = "unnamed"


@dataclass(frozen=True)
class Digest:
    """How proteins are cut, and which columns hold them."""

    id_column: str = "doc_id"
    sequence_column: str = "text"
    group_column: str = "source"
    missed_cleavages: int = 2
    least_length: int = 6
    most_length: int = 50


def settings(kind: type[T], text: str | None) -> T:
    """The settings in a JSON object; unknown names and other types are refused."""
    given: dict[str, Any] = json.loads(text) if text else {}
    known = {f.name: f.default for f in fields(kind)}  # type: ignore[arg-type]
    for name, value in given.items():
        if name not in known:
            raise ValueError(f"unknown setting {name}; known are {', '.join(sorted(known))}")
        if not isinstance(value, type(known[name])) or isinstance(value, bool) != isinstance(known[name], bool):
            raise ValueError(f"setting {name} has to be like {known[name]!r}")
    return kind(**given)


def named(column: str) -> Column:
    text = F.col(f"`{column}`").cast("string")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNNAMED))


def count(df: DataFrame, what: str, path: str) -> int:
    n = df.count()
    LOG.info("%s %d rows: %s", what, n, path)
    return n


def main(name: str, kind: type[T], work: Callable[[SparkSession, argparse.Namespace, T], dict[str, int]], arguments: dict[str, str], argv: list[str] | None = None) -> int:
    """Parses the arguments, makes a session, does the work and stops it."""
    parser = argparse.ArgumentParser(prog=f"jobs.{name}")
    for argument, said in arguments.items():
        parser.add_argument(f"--{argument}", required=True, help=said)
    parser.add_argument("--config", help="JSON file of settings, at any path that Spark reads")
    parser.add_argument("--master", default="local[*]")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.WARNING, format="%(asctime)s %(name)s %(message)s", stream=sys.stderr)
    LOG.setLevel(logging.INFO)
    spark = ship(session(args.master))
    try:
        text = spark.read.option("wholetext", True).text(args.config).head()[0] if args.config else None
        done = work(spark, args, settings(kind, text))
    finally:
        spark.stop()
    print(json.dumps(done, sort_keys=True))
    return 0
