"""Date parsing with an explicit list of formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yy"]


def parse_date(col: Column, formats: list[str] | None = None) -> Column:
    """The first format that fits, as a timestamp without time zone. Null when none does."""
    tries = [F.try_to_timestamp(col, F.lit(f)) for f in (formats or DATE_FORMATS)]
    return F.coalesce(*tries).cast("timestamp_ntz")
