"""Text splitting with the conventions of the input formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = "[ \\t\\n\\r]+"


def tokens(text: Column) -> Column:
    """Whitespace tokens of running text, empty ones left out."""
    return F.array_remove(F.split(text, BLANKS), "")


def fields(line: Column) -> Column:
    """Tab-separated fields; separators at the end of the line open no field."""
    return F.split(F.regexp_replace(line, "\\t+$", ""), "\\t")


def words(gram: Column) -> Column:
    """Whitespace words of an n-gram; leading blanks do open an (empty) word."""
    return F.split(F.regexp_replace(gram, "\\s+$", ""), "\\s+")


def spaced(text: Column) -> Column:
    """Parts separated by single spaces; a text of spaces only has no part."""
    stripped = F.rtrim(text)
    return F.when((stripped == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, " "))


def _up_to(most: str) -> str:
    """Pattern of the decimal numbers from 0 to ``most``, leading zeros allowed."""
    rest = len(most) - 1
    choices = [f"[0-9]{{1,{rest}}}", most]
    choices += [f"{most[:i]}[0-{int(d) - 1}][0-9]{{{rest - i}}}" for i, d in enumerate(most) if d != "0"]
    return f"0*(?:{'|'.join(choices)})"


# A count: any whole number, zero-padded or not, whose size fits a bigint.
COUNT = f"[+-]?{_up_to(str(2**63 - 1))}"


def whole_number(text: Column) -> Column:
    """A count as bigint, or null where the text is none."""
    return F.when(text.rlike(f"^{COUNT}$"), text.try_cast("bigint"))


# Sums of counts and products of counts: no corpus fills 38 digits.
WIDE = "decimal(38,0)"


def wide(count: Column) -> Column:
    """A count for sums that may pass 64 bits."""
    return count.cast(WIDE)


def narrow(total: Column) -> Column:
    """A wide sum as bigint, or null where it does not fit."""
    return total.try_cast("bigint")
