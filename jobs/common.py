"""What the jobs share: configuration, sessions and paths."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path
from typing import TypeVar

import yaml
from pydantic import BaseModel, ConfigDict
from pyspark.sql import SparkSession

log = logging.getLogger("jobs")
C = TypeVar("C", bound="JobConfig")


class JobConfig(BaseModel):
    """Options of a job; those that it does not know are errors."""

    model_config = ConfigDict(extra="forbid")


def as_pattern(path: str) -> str:
    """A path as a pattern that matches nothing else: a stream takes a plain path for a folder, and a table may be one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def parse(kind: type[C], about: str, paths: dict[str, str], argv: list[str] | None) -> tuple[C, dict[str, str]]:
    """The configuration and the plain paths of a command line; a configuration file beside the job is the default."""
    parser = argparse.ArgumentParser(description=about)
    parser.add_argument("--config", required=True, help="a small YAML file")
    for name, meaning in paths.items():
        parser.add_argument(f"--{name}", required=True, help=meaning)
    given = vars(parser.parse_args(argv))
    config = kind.model_validate(yaml.safe_load(Path(given.pop("config")).read_text(encoding="utf-8")) or {})
    return config, given


def session(name: str) -> SparkSession:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
