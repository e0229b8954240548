"""Time literals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moment(at: datetime, kind: T.DataType | str = "timestamp") -> Column:
    """A naive ``at`` as a literal: wall clock in the session's time zone.

    Passed as text. ``F.lit`` would read it in the time zone of the Python
    process, which may be another one than that of the session.
    """
    if at.tzinfo is not None:
        raise ValueError("give the time as wall clock of the session's time zone")
    return F.lit(at.isoformat(sep=" ")).cast(kind)
