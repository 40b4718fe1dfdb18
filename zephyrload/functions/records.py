"""Record-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: records per page of the electricity service.
PAGE_SIZE = 5000

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"


def row_key(*parts: Column) -> Column:
    """P5: stable key of a record; an absent part counts as empty text."""
    filled = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.md5(F.concat_ws("-", *filled))


def zone_letter(code: Column) -> Column:
    """The part after the first ``N`` of a sub-area code, NULL without one."""
    return F.get(F.split(code, "N"), F.lit(1))


def number_or_null(text: Column) -> Column:
    """text as double; anything that is not a plain number is NULL."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def page_number(offset: Column, page_size: int = PAGE_SIZE) -> Column:
    """1-based page of a record offset."""
    return (F.floor(offset / F.lit(page_size)) + 1).cast("long")
