"""Text columns in comparable form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, as \s means it under (?U).
EDGES = r"(?U)^\s+|\s+$"
INNER = r"(?U)\s+"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end; null stays null."""
    return F.regexp_replace(c, EDGES, "")


def reference(c: Column) -> Column:
    """A reference as it is compared: stripped and lower-cased; null where nothing is left."""
    return F.nullif(F.lower(strip(c)), F.lit(""))
