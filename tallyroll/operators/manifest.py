"""File-level operators: identity, pending files, header versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.functions import blank, deal_name, file_name, report_date, strip, vendor_name
from tallyroll.schemas import FILE_KEY


def with_identity(files: DataFrame) -> DataFrame:
    """Deal, vendor, file name and report date of each file, from its path."""
    path = F.col("path")
    return files.withColumns(
        {
            "deal_name": deal_name(path),
            "vendor_name": vendor_name(path),
            "file_name": file_name(path),
            "report_date": report_date(file_name(path)),
        }
    )


def one_per_identity(files: DataFrame) -> DataFrame:
    """One path for each (deal, vendor, file name), should several roots hold it."""
    others = [c for c in files.columns if c not in (*FILE_KEY, "path")]
    return (
        files.groupBy(*FILE_KEY)
        .agg(F.min(F.struct("path", *others)).alias("kept"))
        .select(*FILE_KEY, "kept.*")
    )


def repeated_identity(files: DataFrame) -> DataFrame:
    """Add `repeats`: the path that is taken instead, for all but the first path of one identity.
    An identity has as many rows as there are roots."""
    first = F.min("path").over(Window.partitionBy(*FILE_KEY))
    return files.withColumn("repeats", F.when(F.col("path") != first, first))


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not hold."""
    return files.join(ledger.select(*FILE_KEY), FILE_KEY, "left_anti")


def append_new(held: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not held yet."""
    return incoming.join(held.select(*keys), list(keys), "left_anti")


def header_names(header: Column) -> Column:
    """Header fields as compared: dots are spaces, outer space and case do not count."""
    return F.transform(
        header,
        lambda name, i: F.when(blank(name), F.concat(F.lit("_c"), i.cast("string"))).otherwise(
            F.lower(strip(F.replace(name, F.lit("."), F.lit(" "))))
        ),
    )


def header_signature(header: Column) -> Column:
    """A file's header version: its names in file order, joined by commas."""
    return F.array_join(header_names(header), ",")


def header_versions(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Header versions new to their deal and vendor, dated by the earliest file."""
    keys = ["deal_name", "vendor_name", "file_headers"]
    seen = files.groupBy(*keys).agg(F.min("report_date").alias("report_date"))
    return append_new(registry, seen, keys).select(
        "deal_name", "vendor_name", "report_date", "file_headers", F.now().alias("create_date")
    )
