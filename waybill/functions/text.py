"""Text column helpers for log lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the space counts as blank.
BLANKS = "".join(chr(code) for code in range(0x21))

# A whole number with blanks around it. Possessive quantifiers: no backtracking.
WHOLE_NUMBER = r"[\x00-\x20]*+[+-]?[0-9]++[\x00-\x20]*+"


def strip_blanks(text: Column) -> Column:
    """Drop blanks (control characters too, unlike plain ``trim``) at both ends."""
    return F.trim(text, F.lit(BLANKS))
