"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icdspark.functions._util import as_col

# Fixed value: the only timestamp layout the loader parses (the pattern argument
# of the original helper is ignored).
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"


def iso_to_date(text) -> Column:
    """c19: ISO-8601 timestamp with zone offset -> DATE (UTC)."""
    return F.to_date(F.to_timestamp(as_col(text), ISO_PATTERN))
