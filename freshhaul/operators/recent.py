"""The last readings of each truck, kept up to date batch by batch.

The table has one row per truck with its last readings, oldest first. A batch is cut to
as many rows per truck in each map task, then merged with what is stored, so views over
the newest readings cost the fleet's size and never scan the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.operators.windows import last_rows
from freshhaul.reference import SEQUENCE_LENGTH
from freshhaul.schemas import READING_COLUMNS

ORDER = ["event_time", "event_id"]


def _rings(rows: DataFrame, n: int) -> DataFrame:
    """Arrays of at most ``n`` readings; ``rows`` may have more per truck."""
    packed = F.struct("_rn", *READING_COLUMNS)
    kept = last_rows(rows, "truck_id", ORDER, n).groupBy("truck_id")
    newest_last = kept.agg(F.sort_array(F.collect_list(packed), asc=False).alias("_rows"))
    reading = lambda r: F.struct(*[r[c].alias(c) for c in READING_COLUMNS])
    return newest_last.select("truck_id", F.transform("_rows", reading).alias("readings"))


def recent_readings(df: DataFrame, n: int = SEQUENCE_LENGTH) -> DataFrame:
    """The table over a whole history."""
    return _rings(df.filter(F.col("truck_id").isNotNull()), n)


def merge_recent(stored: DataFrame, batch: DataFrame, n: int = SEQUENCE_LENGTH) -> DataFrame:
    """The stored table after ``batch``, whose rows may be late or stored already.

    A batch that is merged again changes nothing: readings are told apart by event id.
    """
    new = last_rows(batch.filter(F.col("truck_id").isNotNull()), "truck_id", ORDER, n)
    both = unpacked(stored).unionByName(new.select("truck_id", *READING_COLUMNS))
    return _rings(both.dropDuplicates(["truck_id", "event_id"]), n)


def unpacked(recent: DataFrame) -> DataFrame:
    """One row per reading of the table."""
    return recent.select("truck_id", F.inline("readings"))


def newest(recent: DataFrame) -> DataFrame:
    """The last reading of each truck."""
    return recent.select("truck_id", F.element_at("readings", -1).alias("_r")).select("truck_id", "_r.*")


def full_rings(recent: DataFrame, n: int = SEQUENCE_LENGTH) -> DataFrame:
    """Trucks that have all ``n`` readings."""
    return recent.filter(F.size("readings") == n)
