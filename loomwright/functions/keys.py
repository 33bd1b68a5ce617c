"""Key conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks that may stand around a key.
BLANKS = " \t"


def trimmed(column: Column | str) -> Column:
    """Without outer blanks and tabs."""
    return F.btrim(F.col(column) if isinstance(column, str) else column, F.lit(BLANKS))


def canonical(column: Column | str) -> Column:
    """A path or slug in its one form; null where it is null or empty and so refers to nothing."""
    return F.nullif(F.translate(F.lower(trimmed(column)), "-", "_"), F.lit(""))
