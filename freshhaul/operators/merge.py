"""Keeping keyed tables in step: new rows only, upsert, retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.functions.times import moment
from freshhaul.operators.enrich import settled
from freshhaul.operators.windows import latest_by


def known_ids(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(key).distinct()


def known_among(known: DataFrame, candidates: DataFrame, key: str = "event_id") -> DataFrame:
    """The stored ids that occur among the candidates.

    A batch is small against the stored table. With its ids settled and
    broadcast, the stored table is scanned for one column and not shuffled.
    """
    return known.select(key).join(settled(known_ids(candidates, key)), key, "left_semi")


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The earliest row per key; copies are cut down in each map task before the shuffle."""
    oldest = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(oldest)).filter("_rn = 1").drop("_rn")


def new_only(
    df: DataFrame, known: DataFrame, key: str = "event_id", order: str = "event_time"
) -> DataFrame:
    """Rows whose key is not stored yet, one per key (the earliest).

    A null key matches nothing, so such rows all stay, in each run anew: nothing tells
    whether they are stored. They take a number of their own as key, which spreads them
    and leaves one evaluation of ``df``.
    """
    own = F.concat(F.lit("null-"), F.monotonically_increasing_id().cast("string"))
    text = F.col(key).cast("string")
    keyed = df.withColumn("_key", F.when(text.isNull(), own).otherwise(F.concat(F.lit("key-"), text)))
    stored = known.select(F.concat(F.lit("key-"), F.col(key).cast("string")).alias("_key"))
    return first_by(keyed, "_key", [order]).join(stored, "_key", "left_anti").select(*df.columns)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    changed_on: str,
    now: datetime,
    stamp: str = "updated_at",
) -> DataFrame:
    """The target after merging ``updates``, as a new snapshot.

    A new key is inserted; a stored one is replaced only where ``changed_on``
    differs (null-safe), and only then gets a new ``stamp``. Updates without a key
    are left out; of several for one key the last by ``changed_on`` counts.
    """
    order = [changed_on, *[c for c in updates.columns if c not in (key, changed_on)]]
    last = latest_by(updates.filter(F.col(key).isNotNull()), key, order)
    old, new = target.alias("old"), last.alias("new")
    is_new = F.col(f"old.{key}").isNull()
    differs = ~F.col(f"old.{changed_on}").eqNullSafe(F.col(f"new.{changed_on}"))
    take = F.col(f"new.{key}").isNotNull() & (is_new | differs)
    written = moment(now, target.schema[stamp].dataType)
    columns = [
        F.when(take, written).otherwise(F.col(f"old.{stamp}")).alias(stamp)
        if name == stamp
        else F.when(take, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        for name in target.columns
    ]
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*columns)


def prune(df: DataFrame, now: datetime, hours: float, column: str = "event_time") -> DataFrame:
    """Rows that a ``DELETE ... WHERE column < now - hours`` would leave."""
    cutoff = moment(now - timedelta(hours=hours), df.schema[column].dataType)
    return df.filter(F.col(column).isNull() | (F.col(column) >= cutoff))
