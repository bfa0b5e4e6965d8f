"""Conformed rows to payment rows, and the totals the ledger keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions import (
    amount,
    unreadable_amount,
    any_date,
    blank,
    blank_to_null,
    iso_text,
    or_else,
    title_ascii,
)
from tallyroll.schemas import FILE_KEY, PAYMENT, TITLE_COLUMNS, TOTAL, Destination


def with_sale_category(files: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add each file's sale category, null where its vendor has none.

    The lookup may hold a vendor twice; the least category is taken, so the result does
    not depend on row order. Joined per file, not per row.
    """
    per_vendor = lookup.groupBy("vendor_name").agg(F.min("sales_category").alias("sale_category"))
    return files.join(per_vendor, "vendor_name", "left")


def fill_defaults(rows: DataFrame) -> DataFrame:
    """Fill track from type, artist from deal, play date from report date.

    `play_day` is the parsed play date and `release_day` the parsed release date.
    """
    filled = rows.withColumns(
        {
            "Track": or_else(F.col("Track"), F.col("Type")),
            "Artist": or_else(F.col("Artist"), F.col("deal_name")),
            "Play_Date": or_else(F.col("Play_Date"), iso_text(F.col("report_date"))),
        }
    )
    return filled.withColumns(
        {"play_day": any_date(F.col("Play_Date")), "release_day": any_date(F.col("Release_Date"))}
    )


def reject_reason() -> Column:
    """Why a filled row cannot be loaded; null where it can."""
    return (
        F.when(F.col("bad_amount").isNotNull(), F.concat(F.lit("not a number: "), "bad_amount"))
        .when(unreadable_amount(F.col("Net_Payment")), F.lit("not a number: Net_Payment"))
        .when(F.col("play_day").isNull(), F.lit("not a date: Play_Date"))
        .when(
            F.col("release_day").isNull() & ~blank(F.col("Release_Date")),
            F.lit("not a date: Release_Date"),
        )
    )


def engine_values() -> dict[str, Column]:
    """The columns that the engine sets, from the facts of a row's file: the same in all its rows."""
    return {
        "Deal": F.col("deal_name"),
        "Report_Date": iso_text(F.col("report_date")),
        "Sale_Category": F.col("sale_category"),
        "File_Name": F.col("file_name"),
    }


def payment_rows(filled: DataFrame, to: Destination = PAYMENT) -> DataFrame:
    """Destination columns in table order, all text, plus the engine's typed columns."""
    value = {
        **engine_values(),
        "Play_Date": iso_text(F.col("play_day")),
        "ISRC": blank_to_null(F.col("ISRC")),
        **{c: title_ascii(F.col(c)) for c in TITLE_COLUMNS if c in to.columns},
    }
    return filled.select(
        *[(value[c] if c in value else blank_to_null(F.col(c))).cast("string").alias(c) for c in to.columns],
        "deal_name",
        "vendor_name",
        "file_path",
        amount(F.col("Net_Payment")).alias("net_amount"),
        F.coalesce("release_day", "play_day").alias("song_date"),
        reject_reason().alias("reject"),
    )


def file_outcomes(payments: DataFrame) -> DataFrame:
    """Bad rows and exact amount of each file by reject reason (null for good rows).

    The one aggregate over payment rows that both the reject list and the ledger are read
    from. Partial sums make a huge file one row per task and reason.
    """
    return payments.groupBy(
        "file_path", "deal_name", "vendor_name", F.col("File_Name").alias("file_name"), "reject"
    ).agg(F.count("reject").alias("bad_rows"), F.sum("net_amount").cast(TOTAL).alias("amount"))


def ledger_totals(outcomes: DataFrame) -> DataFrame:
    """Exact payment total of each file that has no bad row."""
    return (
        outcomes.groupBy(*FILE_KEY)
        .agg(F.sum("amount").cast(TOTAL).alias("total_net_payment"), F.sum("bad_rows").alias("bad_rows"))
        .where("bad_rows = 0")
        .drop("bad_rows")
    )


def ledger_rows(files: DataFrame, totals: DataFrame) -> DataFrame:
    """Ledger rows of loaded files; a file without rows is entered with a null total."""
    return files.join(totals, FILE_KEY, "left").select(
        *FILE_KEY, F.current_date().alias("processed_date"), "total_net_payment"
    )
