"""Text cleaning as column expressions; each stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as whitespace at the ends of a text.
_SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
_NOT_ASCII = r"[^\x00-\x7F]"

# Letters, and ASCII characters that are neither letter nor space. Each is named, as the regular
# expression engine looks such sets up in a table and tries ranges one after the other.
_LETTER = "[ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz]"
_SIGN = "[" + "".join(f"\\x{i:02x}" for i in range(128) if chr(i) != " " and not chr(i).isalpha()) + "]"

# Not ASCII, so it cannot occur in text that title_ascii has already stripped to ASCII.
_WORD_MARK = "§ "


def strip(c: Column) -> Column:
    """Drop whitespace of any kind at both ends; plain `trim` drops spaces only."""
    return F.trim(c, F.lit(_SPACES))


def blank(c: Column) -> Column:
    """True for null, empty and all-whitespace text; never null.

    Text from `!` on begins with something visible, which settles most rows by one
    comparison.
    """
    return F.when(c >= "!", F.lit(False)).otherwise(F.coalesce(strip(c), F.lit("")) == "")


def blank_to_null(c: Column) -> Column:
    return F.when(~blank(c), c)


def or_else(c: Column, default: Column) -> Column:
    """`c`, or `default` where `c` is blank."""
    return F.when(blank(c), default).otherwise(c)


def ascii_only(c: Column) -> Column:
    """Drop characters outside ASCII; text that has none costs no regular expression."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.regexp_replace(c, _NOT_ASCII, ""))


def ascii_clean(c: Column) -> Column:
    """Drop characters outside ASCII, then whitespace at both ends.

    Trimming a set of characters takes a text apart; most texts begin and end with something
    visible, which two comparisons tell.
    """
    whole = (c >= "!") & (F.octet_length(c) == F.length(c)) & (F.substring(c, -1, 1) >= "!")
    return F.when(whole, c).otherwise(strip(ascii_only(c)))


def title_ascii(c: Column) -> Column:
    """ASCII title case: a letter is upper case exactly where no letter precedes it.

    `initcap` starts a word at a space only (`don't` -> `Don't`), so a marked space is
    put in front of every letter that follows another kind of non-letter, and taken out
    again afterwards (`Don'T`, `Ac/Dc`, `3Rd`). Blank text becomes null.
    """
    text = ascii_only(c)
    marked = F.regexp_replace(text, f"({_SIGN})(?={_LETTER})", "$1" + _WORD_MARK)
    inner_word = text.rlike(_SIGN + _LETTER)
    titled = F.when(
        inner_word, F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))
    ).otherwise(F.initcap(text))
    return F.when(~blank(c), titled)


def key_text(c: Column) -> Column:
    """Join-key form of an optional text: blank becomes one space, so that keys match."""
    return F.when(blank(c), F.lit(" ")).otherwise(c)
