"""Header layouts as data: where in each file every destination column is found.

Resolving per file, as columns, lets one scan conform any number of header versions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.manifest import header_names, header_signature
from tallyroll.schemas import PAYMENT, Destination
from tallyroll.sources.mapping import Alias, check_mapping, header_key


def position_name(target: str) -> str:
    return f"at_{target}"


def parts_name(target: str) -> str:
    return f"parts_{target}"


def aliases_of(mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT) -> dict[str, list[Alias]]:
    """Aliases of each column a file can supply, the column's own name first.

    A target that is no such column is an error: its values would be lost without a trace.
    """
    parsed = {header_key(t): aliases for t, aliases in check_mapping(mapping).items()}
    unknown = parsed.keys() - {header_key(t) for t in to.file_columns}
    if unknown:
        raise ValueError(f"mapping for columns that the destination lacks: {', '.join(sorted(unknown))}")
    return {
        t: [Alias((header_key(t),), False), *parsed.get(header_key(t), [])] for t in to.file_columns
    }


def summed_columns(mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT) -> dict[str, int]:
    """Columns that some alias fills by a sum, with the largest number of parts."""
    sizes = {
        t: max((len(a.parts) for a in aliases if a.is_sum), default=0)
        for t, aliases in aliases_of(mapping, to).items()
    }
    return {t: n for t, n in sizes.items() if n}


def layout_columns(mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT) -> list[str]:
    """Columns that `resolve` adds and `conform` reads."""
    return [position_name(t) for t in to.file_columns] + [parts_name(t) for t in summed_columns(mapping, to)]


def _position(names: Column, name: str) -> Column:
    """Zero-based position of a header name, -1 where it is absent."""
    return (F.array_position(names, F.lit(name)) - 1).cast("int")


def resolve(files: DataFrame, mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT) -> DataFrame:
    """Add signature and layout to files with a `header`.

    For each column the first alias found in the header wins. `at_<column>` is its
    position; for a sum `parts_<column>` holds the positions to add.
    """
    named = files.withColumn("_names", header_names(F.col("header")))
    names = F.col("_names")
    sums = summed_columns(mapping, to)

    layout = {}
    for target, aliases in aliases_of(mapping, to).items():
        at, parts = F.when(F.lit(False), F.lit(None).cast("int")), None
        if target in sums:
            parts = F.when(F.lit(False), F.lit(None).cast("array<int>"))
        for alias in aliases:
            places = [_position(names, p) for p in alias.parts]
            found = F.least(*places, F.lit(0).cast("int")) >= 0
            if alias.is_sum:
                at = at.when(found, F.lit(None).cast("int"))
                parts = parts.when(found, F.array(*places))
            else:
                at = at.when(found, places[0])
                if parts is not None:
                    parts = parts.when(found, F.lit(None).cast("array<int>"))
        layout[position_name(target)] = at
        if parts is not None:
            layout[parts_name(target)] = parts

    problem = (
        F.when(F.col("report_date").isNull(), F.lit("no report date in file name"))
        .when(F.col("header_problem").isNotNull(), F.col("header_problem"))
        .when(F.col("header").isNull(), F.lit("no header line"))
        .when(F.size(F.array_distinct(names)) < F.size(names), F.lit("repeated header name"))
    )
    return named.withColumns(
        {"file_headers": header_signature(F.col("header")), "problem": problem, **layout}
    ).drop("_names", "header", "header_problem")
