"""What the jobs share: configuration, logs, and the command line's session."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

LOG = logging.getLogger("jobs")


def config_of(name: str, path: str | None = None, **changed) -> dict:
    """The job's settings: those beside its module, then those of a file, then single ones. Unknown names are errors."""
    settings = json.loads((Path(__file__).parent / f"{name}.json").read_text(encoding="utf-8"))
    for more in (json.loads(Path(path).read_text(encoding="utf-8")) if path else {}, changed):
        if unknown := sorted(set(more) - set(settings)):
            raise ValueError(f"{name}: no such setting: {', '.join(unknown)}")
        settings |= more
    return settings


def main(name: str, paths: list[str], run: Callable, doc: str) -> int:
    """Runs a job from the command line: an option for each path, and --config; makes and stops the session."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=doc.splitlines()[0])
    for p in paths:
        parser.add_argument(f"--{p}", required=True)
    parser.add_argument("--config", help=f"a JSON file with settings that differ from jobs/{name}.json")
    args = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", stream=sys.stderr)
    config = config_of(name, args.pop("config"))
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, *(args[p] for p in paths), config)
    finally:
        spark.stop()
    return 0
