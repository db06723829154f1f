"""String helpers as native column expressions."""

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space that trimming removes, and the integer and float spellings
# accepted in numeric fields.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
PLAIN_INTEGER_PATTERN = r"^[0-9]{1,18}$"
INTEGER_PATTERN = r"^[+-]?\p{Nd}+(_\p{Nd}+)*$"
FLOAT_PATTERN = (
    r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
)
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"


# decimal digits outside ASCII, ten of each script in the order 0 to 9
OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def _ascii_digits(c: Column) -> Column:
    """Decimal digits of other scripts as 0 to 9."""
    return F.translate(c, OTHER_DIGITS, "0123456789" * (len(OTHER_DIGITS) // 10))


def integer(c: Column) -> Column:
    """DECIMAL(38, 0) value of an integer literal, or null when it is not one.

    Blanks around it, a sign, single underscores between digits and the decimal digits of any script are
    accepted. A number of more than 38 digits becomes the largest of that sign, which every range refuses.
    """
    bare = strip(c)
    number = F.replace(_ascii_digits(bare), F.lit("_"), F.lit(""))
    largest = F.lit("9" * 38).cast("decimal(38,0)")
    fitted = F.coalesce(number.try_cast("decimal(38,0)"), F.when(number.startswith("-"), -largest).otherwise(largest))
    loose = F.when(bare.rlike(INTEGER_PATTERN), fitted)
    return F.when(c.rlike(PLAIN_INTEGER_PATTERN), c.try_cast("decimal(38,0)")).otherwise(loose)


def float_value(c: Column) -> Column:
    """Double value of a float literal, null when it is not one (infinities included)."""
    bare = strip(c)
    return F.when(bare.rlike(FLOAT_PATTERN), F.regexp_replace(bare, "_", "").try_cast("double")).when(
        bare.rlike(INFINITY_PATTERN),
        F.when(bare.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
    )
