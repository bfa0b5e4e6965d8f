"""Rows of any layout to the destination's columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions import amount_text, ascii_clean, blank, combined_amount, plain_number
from tallyroll.operators.layout import (
    aliases_of,
    layout_columns,
    parts_name,
    position_name,
    summed_columns,
)
from tallyroll.schemas import PAYMENT, Destination
from tallyroll.sources.mapping import header_key

# About a kilobyte each, so at most some twenty megabytes.
BROADCAST_FILES = 20_000

# Per-file facts every row carries.
FILE_FACTS = ["file_path", "deal_name", "vendor_name", "file_name", "report_date", "sale_category"]


def _part_columns(target: str, size: int) -> list[str]:
    """Columns for the cells of a sum; as many as the mapping's longest sum has parts."""
    return [f"part{i}_{target}" for i in range(size)]


def _cleaned_cells(rows: DataFrame, sums: Mapping[str, int], to: Destination) -> DataFrame:
    """Add `text_<column>` for every column and `part<i>_<column>` for sums, all cleaned.

    In two steps, so that a cell is taken out and cleaned once however often it is used.
    """
    cells = F.col("cells")
    raw = {f"text_{t}": F.get(cells, F.col(position_name(t))) for t in to.file_columns}
    for t, size in sums.items():
        for i, name in enumerate(_part_columns(t, size)):
            raw[name] = F.get(cells, F.get(F.col(parts_name(t)), F.lit(i)))
    taken = rows.withColumns(raw).drop("cells")
    return taken.withColumns({name: ascii_clean(F.col(name)) for name in raw})


def _sum_of_parts(target: str, size: int) -> Column:
    """The parts' exact sum, null without parts or where one is not a number."""
    total = combined_amount([F.col(name) for name in _part_columns(target, size)])
    return F.when(F.col(parts_name(target)).isNotNull(), total)


def _part_of_sum(target: str, mapping: Mapping[str, Sequence[str]], to: Destination) -> list[str]:
    """Summed columns that use the column `target` as a part."""
    name = header_key(target)
    return [
        t
        for t, aliases in aliases_of(mapping, to).items()
        if any(a.is_sum and name in a.parts for a in aliases)
    ]


def is_few(files: DataFrame) -> bool:
    """Whether the facts of so many files may be broadcast."""
    return files.select("file_path").limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES


def _broadcast_if_few(facts: DataFrame) -> DataFrame:
    """File facts to be broadcast after a count of them; Spark chooses the join for more. Rows
    would otherwise be shuffled by file, and one file may hold much of the data."""
    return F.broadcast(facts) if is_few(facts) else facts


def conform(
    rows: DataFrame, layouts: DataFrame, mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT
) -> DataFrame:
    """Rows (`cells`, `file_path`) as destination columns plus their file's facts.

    Every column a file can supply is there, as cleaned text, null where the file lacks
    it; only `Source` is then the vendor. `bad_amount` names a summed column with a part that is not a number.
    """
    sums = summed_columns(mapping, to)
    facts = layouts.select(*FILE_FACTS, *layout_columns(mapping, to))
    joined = rows.join(_broadcast_if_few(facts), "file_path")
    cleaned = _cleaned_cells(joined, sums, to)
    if sums:
        cleaned = cleaned.withColumns({f"sum_{t}": _sum_of_parts(t, n) for t, n in sums.items()})

    def by_sum(target: str) -> Column:
        return F.col(parts_name(target)).isNotNull()

    def value(target: str) -> Column:
        text = F.col(f"text_{target}")
        value = F.when(text != "", text)
        users = [t for t in _part_of_sum(target, mapping, to) if t != target]
        if users:
            # A column that was summed stays as the plain number that went into the sum.
            at = F.col(position_name(target))
            used = reduce(
                Column.__or__,
                [F.coalesce(F.array_contains(parts_name(t), at), F.lit(False)) for t in users],
            )
            plain = F.when(blank(text), F.lit("0.0")).otherwise(plain_number(text))
            value = F.when(used, plain).otherwise(value)
        if target in sums:
            value = F.when(by_sum(target), amount_text(F.col(f"sum_{target}"))).otherwise(value)
        if target == "Source":
            value = F.when(F.col(position_name(target)).isNull(), F.col("vendor_name")).otherwise(value)
        return value.alias(target)

    bad = F.lit(None).cast("string")
    for t in reversed(list(sums)):
        bad = F.when(by_sum(t) & F.col(f"sum_{t}").isNull(), F.lit(t)).otherwise(bad)
    return cleaned.select(*FILE_FACTS, *[value(t) for t in to.file_columns], bad.alias("bad_amount"))
