"""Destination schemas. These names and orders are the public data model."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import types as T

# Destination columns of a new payment fact table, in table order.
PAYMENT_COLUMNS = [
    "Deal",
    "Source",
    "Report_Date",
    "Artist",
    "Track",
    "Album",
    "ISRC",
    "Play_Date",
    "Release_Date",
    "Sale_Category",
    "Quantity",
    "Net_Payment",
    "Service_Provider",
    "Service_Type",
    "Territory",
    "File_Name",
]

# Columns stored in title case.
TITLE_COLUMNS = [
    "Artist",
    "Track",
    "Album",
    "Service_Provider",
    "Service_Type",
    "Territory",
]

# Set by the engine for every row, whatever the file says.
ENGINE_COLUMNS = ["Deal", "Report_Date", "Sale_Category", "File_Name"]

# A source column that only fills a blank track and is not stored itself.
TYPE_COLUMN = "Type"

SONG_KEY = ["ISRC", "Artist", "Track", "Album"]
SONG_COLUMNS = ["id", *SONG_KEY, "Release_Date", "is_latest"]

# What identifies one statement file.
FILE_KEY = ["deal_name", "vendor_name", "file_name"]

# Twenty-eight digits, ten after the point: royalty lines go far below a cent, and
# decimal sums do not depend on the order in which partitions are added.
AMOUNT = "decimal(28,10)"
TOTAL = "decimal(38,10)"


def _strings(names):
    return [T.StructField(n, T.StringType()) for n in names]


def _total():
    return T.DecimalType(38, 10)


# What a payment row has beside the destination columns: the file identity, the typed amount,
# the typed song date and the reject reason.
_PAYMENT_FACTS = [
    *_strings(["deal_name", "vendor_name", "file_path"]),
    T.StructField("net_amount", T.DecimalType(28, 10)),
    T.StructField("song_date", T.DateType()),
    T.StructField("reject", T.StringType()),
]

# Destination columns that loads work with, which no destination can do without.
_NEEDED = [*SONG_KEY, "Play_Date", "Release_Date", "Net_Payment", "Report_Date", "File_Name"]
# Names that rows carry on their way, beside destination columns.
_TAKEN = [*FILE_KEY[:2], "file_path", "net_amount", "song_date", "reject", "load_id", "bad_amount", "play_day", "release_day"]


class Destination(NamedTuple):
    """The payment table's columns, in table order.

    A column that the engine does not set is filled from a file's column of that name or by the
    mapping, and is null where a file has neither.
    """

    columns: tuple[str, ...]

    @property
    def file_columns(self) -> list[str]:
        """Columns a file can supply."""
        return [c for c in self.columns if c not in ENGINE_COLUMNS] + [TYPE_COLUMN]

    @property
    def schema(self) -> T.StructType:
        """Stored form of the payment table."""
        return T.StructType([*_strings(self.columns), *_PAYMENT_FACTS])


def destination(columns: Iterable[str]) -> Destination:
    """A destination with these columns; refuses names that loads could not keep apart."""
    made = Destination(tuple(columns))
    lower = [c.strip().lower() for c in made.columns]
    missing = [c for c in _NEEDED if c not in made.columns]
    if missing:
        raise ValueError(f"the destination lacks {', '.join(missing)}")
    if len(set(lower)) < len(lower):
        raise ValueError("two destination columns differ only in case")
    odd = [c for c, name in zip(made.columns, lower, strict=True) if not name or "." in c or "`" in c]
    odd += [c for c, name in zip(made.columns, lower, strict=True) if name in [*_TAKEN, TYPE_COLUMN.lower()]]
    odd += [c for c in made.columns if c not in ENGINE_COLUMNS and c.lower() in [e.lower() for e in ENGINE_COLUMNS]]
    if odd:
        raise ValueError(f"no name for a destination column: {', '.join(map(repr, odd))}")
    return made


PAYMENT = destination(PAYMENT_COLUMNS)

# Names and places of the payment table's columns; a later load of it takes the place of an earlier.
PAYMENT_LAYOUT = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("name", T.StringType())])

# Stored form of the song table: `replaces_id` names the version a row supersedes.
SONG = T.StructType(
    _strings(["id", *SONG_KEY])
    + [
        T.StructField("Release_Date", T.DateType()),
        T.StructField("is_latest", T.StringType()),
        T.StructField("replaces_id", T.StringType()),
    ]
)

# Which song buckets a load has written anew, and the number of buckets.
SONG_BUCKETS = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("buckets", T.IntegerType())]
)

METADATA_MANAGEMENT = T.StructType(
    _strings(["deal_name", "vendor_name"])
    + [
        T.StructField("report_date", T.DateType()),
        T.StructField("file_headers", T.StringType()),
        T.StructField("create_date", T.TimestampType()),
    ]
)

FILE_SUMMARY = T.StructType(
    _strings(FILE_KEY)
    + [
        T.StructField("processed_date", T.DateType()),
        T.StructField("total_net_payment", _total()),
    ]
)

ERROR_SUMMARY = T.StructType(
    _strings(["file_path", "reason"]) + [T.StructField("error_date", T.DateType())]
)

# Loads of a table whose rows another load holds now.
MERGED_LOADS = T.StructType(_strings(["table_name", "merged_id"]))

SALES_CATEGORY_LOOKUP = T.StructType(_strings(["vendor_name", "sales_category"]))
