"""Header mapping: `{target column: [source alias, ...]}` as JSON data.

An alias with `++` names columns to be summed. Earlier aliases win; a column that
already has the target's name wins over all of them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

SUM_MARK = "++"


class Alias(NamedTuple):
    """One way to fill a target: the header names it needs, summed when `is_sum`."""

    parts: tuple[str, ...]
    is_sum: bool


def header_key(name: str) -> str:
    """The form in which header names are compared."""
    return name.replace(".", " ").strip().lower()


def parse_alias(text: str) -> Alias:
    parts = tuple(header_key(p) for p in text.split(SUM_MARK))
    is_sum = SUM_MARK in text
    if is_sum and (len(parts) < 2 or "" in parts):
        raise ValueError(f"combined alias {text!r} has an empty part")
    return Alias(parts, is_sum)


def check_mapping(mapping: Mapping[str, Sequence[str]]) -> dict[str, list[Alias]]:
    """Parsed mapping; refuses one whose result would depend on the order of targets."""
    parsed = {target: [parse_alias(a) for a in aliases] for target, aliases in mapping.items()}
    names = {header_key(t): t for t in parsed}
    if len(names) < len(parsed):
        raise ValueError("two targets differ only in case")
    owner: dict[str, str] = {}
    for target, aliases in parsed.items():
        for alias in aliases:
            if alias.is_sum:
                continue
            name = alias.parts[0]
            other = names.get(name, target)
            if owner.setdefault(name, target) != target or other != target:
                raise ValueError(f"header {name!r} is an alias of more than one target")
    return parsed


def load_mapping(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Read a JSON mapping from any storage Spark can read."""
    mapping = json.loads(spark.read.text(path, wholetext=True).first()[0])
    check_mapping(mapping)
    return mapping


def mapping_table(spark: SparkSession, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """The mapping as rows: target, priority, alias and the header names it needs."""
    rows = [
        (target, priority, text, list(parse_alias(text).parts))
        for target, aliases in mapping.items()
        for priority, text in enumerate(aliases)
    ]
    return spark.createDataFrame(
        rows, "target string, priority int, alias string, parts array<string>"
    )
