"""Values read from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_YEAR = r"part_(\d{4})_"
LEADING_YEAR = r"^(\d{4})"


def year_from_name(name: Column, pattern: str, strict: bool = False) -> Column:
    """Year held in a base file name; without a match NULL, or an error if strict."""
    found = F.regexp_extract(name, pattern, 1)
    year = F.nullif(found, F.lit("")).try_cast("int")
    if not strict:
        return year
    message = F.concat(F.lit("no year in file name: "), F.coalesce(name, F.lit("NULL")))
    return F.coalesce(year, F.raise_error(message).cast("int"))
