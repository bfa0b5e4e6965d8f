"""Deal, vendor and file name from `<root>/<deal>/<vendor>/<file>.csv`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_path(file_path: Column) -> Column:
    """`_metadata.file_path` with its percent-encoding undone; `+` stays `+`."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def path_part(path: Column, from_end: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def file_name(path: Column) -> Column:
    return path_part(path, 1)


def vendor_name(path: Column) -> Column:
    return path_part(path, 2)


def deal_name(path: Column) -> Column:
    return path_part(path, 3)
