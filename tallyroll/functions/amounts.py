"""Money and quantity text as exact decimals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.functions.text import blank
from tallyroll.schemas import AMOUNT

AMOUNT_SCALE = int(AMOUNT.rstrip(")").rsplit(",", 1)[1])


def plain_number(c: Column) -> Column:
    """Number text without thousands commas, dollar signs and outer spaces."""
    return F.trim(F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("$"), F.lit("")))


def amount(c: Column) -> Column:
    """Number text as an exact decimal; null where it is not a number."""
    return plain_number(c).try_cast(AMOUNT)


def unreadable_amount(c: Column) -> Column:
    """True for text that is there and is no exact decimal: no number, too large, or with more
    decimals than are kept. Text no longer than those can't have more of them."""
    digits = F.regexp_extract(plain_number(c), r"\.([0-9]*?)0*$", 1)
    long = (F.length(c) > AMOUNT_SCALE) & (F.length(digits) > AMOUNT_SCALE)
    return ~blank(c) & (amount(c).isNull() | long)


def part_amount(c: Column) -> Column:
    """One part of a combined amount: blank counts as zero, other text must be a number."""
    return F.when(blank(c), F.lit(0).cast(AMOUNT)).otherwise(amount(c))


def combined_amount(parts: Sequence[Column]) -> Column:
    """Sum of the parts; null as soon as one part is not a number."""
    return reduce(lambda a, b: (a + b).try_cast(AMOUNT), [part_amount(p) for p in parts])


def amount_text(c: Column) -> Column:
    """Decimal as text with at least one digit after the point: `1234.5`, `100.0`."""
    return F.regexp_replace(c.cast("string"), r"(\.[0-9]+?)0+$", "$1")
