"""Row-level text and number helpers (all built-in expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from servicelens import schema as S

# A number with an optional decimal comma or point, as float() accepts it
# after the comma is swapped for a point.
_DECIMAL_RE = r"^\s*[+-]?([0-9]+([.,][0-9]*)?|[.,][0-9]+)\s*$"


def drop_third_char(c: Column) -> Column:
    """Remove the third character, by position (P2): "12.345.1" -> "12345.1"."""
    return F.concat(F.substring(c, 1, 2), F.substr(c, F.lit(4)))


def decimal_comma(c: Column) -> Column:
    """Decimal-comma text to DOUBLE; NULL for anything else."""
    s = c.cast("string")
    return F.when(s.rlike(_DECIMAL_RE), F.trim(F.replace(s, F.lit(","), F.lit("."))).try_cast("double"))


def address_parts(c: Column) -> Column:
    """Split on a literal dot (P4); an array of the parts."""
    return F.split(c.cast("string"), "[.]")


def na_to_null(c: Column, markers=S.NA_MARKERS) -> Column:
    """Missing-value markers to SQL NULL (S4).  No trimming."""
    return F.when(~c.isin(*markers), c)


def round2(c: Column, digits: int | None = 2) -> Column:
    """Half-even rounding (P8); ``digits=None`` keeps full precision."""
    return c if digits is None else F.bround(c, digits)


def itemset_label(items: Column, joiner: str = S.ITEM_JOINER) -> Column:
    """Sorted items joined into one label (P10)."""
    return F.concat_ws(joiner, F.array_sort(items))
