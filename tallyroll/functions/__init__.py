"""Column-to-column functions."""

from tallyroll.functions.amounts import (
    amount,
    amount_text,
    combined_amount,
    plain_number,
    unreadable_amount,
)
from tallyroll.functions.dates import any_date, iso_text, report_date
from tallyroll.functions.paths import deal_name, decode_path, file_name, vendor_name
from tallyroll.functions.text import (
    ascii_clean,
    blank,
    blank_to_null,
    key_text,
    or_else,
    strip,
    title_ascii,
)

__all__ = [
    "amount",
    "amount_text",
    "any_date",
    "ascii_clean",
    "blank",
    "blank_to_null",
    "combined_amount",
    "deal_name",
    "decode_path",
    "file_name",
    "iso_text",
    "key_text",
    "or_else",
    "plain_number",
    "report_date",
    "strip",
    "title_ascii",
    "unreadable_amount",
    "vendor_name",
]
