"""Numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(number: Column, digits: int = 6) -> Column:
    """``round`` of a double, digit for digit the same, without its way through decimal text.

    The whole number next to ``number * 10^digits`` is found in binary unless it could be a tie; divided by that power,
    it gives the double nearest to the decimal. Negative, large and missing numbers and possible ties go to ``round``.
    """
    shifted = number * 10.0**digits
    plain = (number >= 0) & (shifted < 1e9) & (F.abs(shifted - F.floor(shifted) - 0.5) > 1e-6)
    return F.when(plain, F.floor(shifted + 0.5) / F.lit(10.0**digits)).otherwise(F.round(number, digits))
