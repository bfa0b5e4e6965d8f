"""Files that cannot be loaded. A file with any bad row is rejected whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _file_reason() -> Column:
    no_category = F.when(F.col("sale_category").isNull(), F.lit("vendor has no sale category"))
    return F.coalesce("problem", no_category)


def file_problems(files: DataFrame) -> DataFrame:
    """Files whose name, header or vendor already rules them out."""
    return files.select("*", _file_reason().alias("reason")).where("reason is not null")


def loadable(files: DataFrame) -> DataFrame:
    """Files that nothing known before reading their rows rules out."""
    return files.where(_file_reason().isNull())


def row_problems(outcomes: DataFrame) -> DataFrame:
    """Files with bad rows, one row per file and reason."""
    # By count, not by reason: a filter on a grouping column moves below the aggregate.
    return outcomes.where("bad_rows > 0").select(
        "file_path", F.col("reject").alias("reason"), "bad_rows"
    )


def accepted(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows (or files) of files that have no problem."""
    return rows.join(rejected.select("file_path"), "file_path", "left_anti")


def error_rows(problems: DataFrame) -> DataFrame:
    return problems.select("file_path", "reason", F.current_date().alias("error_date"))
