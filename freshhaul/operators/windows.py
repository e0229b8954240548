"""Latest rows, exact ranks and sliding sequences that hold up for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.reference import SEQUENCE_LENGTH


def latest_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row per key; later names in ``order`` break ties.

    ``row_number() = 1`` lets Spark keep one row per key and map task before the
    shuffle (WindowGroupLimit), so a hot key costs no more than any other.
    """
    return last_rows(df, key, order, 1).drop("_rn")


def last_rows(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)


def last_n(
    df: DataFrame,
    key: str,
    order: list[str],
    n: int,
    columns: list[str] | None = None,
    out: str = "readings",
) -> DataFrame:
    """Per key an array of its last ``n`` rows, oldest first; keys with fewer are left out."""
    columns = columns or [name for name in df.columns if name != key]
    packed = F.struct("_rn", *columns)
    arrays = (
        last_rows(df, key, order, n)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(packed), asc=False).alias("_rows"))
        .filter(F.size("_rows") == n)
    )
    unpacked = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return arrays.select(key, unpacked.alias(out))


def ranked(df: DataFrame, key: str, slice_by: Column, order: list[Column]) -> DataFrame:
    """Add ``_rank`` (1-based within ``key``) and ``_total``, without one task per key.

    ``slice_by`` cuts each key into runs that agree with ``order``. Rows are
    numbered inside (key, slice); the start of each slice comes from counts that
    are combined on the map side. Both sides of the join are partitioned by
    (key, slice), so the rows are shuffled once. Rows with a null key or slice
    are left out.
    """
    cut = df.withColumn("_slice", slice_by).filter(
        F.col(key).isNotNull() & F.col("_slice").isNotNull()
    )
    sizes = cut.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    by_key = Window.partitionBy(key)
    before = F.sum("_size").over(
        by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        key,
        "_slice",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_size").over(by_key).alias("_total"),
    )
    inside = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    numbered = cut.withColumn("_inside", inside)
    return (
        numbered.join(starts, [key, "_slice"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .drop("_slice", "_inside", "_before")
    )


def sequences(
    df: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    target: str,
    n: int = SEQUENCE_LENGTH,
    keep: list[str] | None = None,
    slice_by: Column | None = None,
    block: int = 4096,
    tasks: int | None = None,
) -> DataFrame:
    """Sliding arrays of ``n`` consecutive rows per key with the target at the last row.

    The window that ends at a key's final row is not produced, and keys with
    fewer than ``n + 1`` rows give none. Rows get an exact rank, then move in
    blocks of ``block`` ranks, each with the ``n - 1`` rows before it, so the
    work is even whatever the size of a key. ``slice_by`` defaults to the hour
    of the first order column. ``tasks`` is for readers that keep the arrays, many
    times the bytes of the rows by which a shuffle is sized.
    """
    if block < n:
        raise ValueError("a block must hold at least one sequence")
    cut = F.date_trunc("hour", order[0]) if slice_by is None else slice_by
    carried = list(dict.fromkeys([key, *order, *columns, target, *(keep or [])]))
    numbered = ranked(df.select(*carried), key, cut, [F.col(c) for c in order])

    home = F.expr(f"(_rank - 1) div {block}")
    lends = F.expr(f"(_rank - 1) % {block}") >= block - (n - 1)
    placed = numbered.withColumn("_home", home).withColumn(
        "_block",
        F.explode(
            F.when(lends, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
        ),
    )
    if tasks:
        placed = placed.repartition(tasks, key, "_block")
    frame = Window.partitionBy(key, "_block").orderBy("_rank").rowsBetween(-(n - 1), 0)
    windowed = placed.withColumn("sequence", F.collect_list(F.struct(*columns)).over(frame))
    return windowed.filter(
        (F.col("_block") == F.col("_home"))
        & (F.col("_rank") >= n)
        & (F.col("_rank") < F.col("_total"))
    ).select(key, *order, *[c for c in keep or [] if c not in (key, *order)], "sequence", target)
