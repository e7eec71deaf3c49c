"""Incremental ingest of event streams into the operational layer.

Each run reads whatever the stream holds beyond the last checkpoint, parses
it, stamps the run date and appends it to the date-partitioned ODS table,
then stops (AvailableNow).  Progress lives in the checkpoint, so a re-run
after a failure resumes without duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from recolake.operators import ods
from recolake.sources.tables import Lakehouse

PARSERS = {
    "Rating": ods.parse_ratings,
    "Tag": ods.parse_tags,
}


def ingest(lake: Lakehouse, raw: DataFrame, table: str, date: str):
    """Parse a (key, value) stream into ODS.<table> for the given run date."""
    parsed = ods.stamp_date(PARSERS[table](raw), date)
    return lake.stream_append(parsed, "ods", table, "date", available_now=True)
