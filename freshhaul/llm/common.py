"""What the operators of this package share."""

from __future__ import annotations

import gc

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.session import scratch_path

# Words are runs of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ROW = ["row_file", "row_index"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: evaluated once, no lineage to repeat."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Let Spark remove the shuffles of frames that are gone: it does so after a collection
    of the driver's garbage, which may not come before the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def with_row(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` and a key of the row, equal in each reading of the same files.

    Rows of files are known by file and position. Rows of a shuffled frame have no name
    that a second evaluation is sure to give them again: ``settle`` such a frame first.
    """
    try:
        return docs.select(
            *columns,
            F.col("_metadata.file_path").alias("row_file"),
            F.col("_metadata.row_index").alias("row_index"),
        )
    except AnalysisException as error:
        raise ValueError("rows are known by their place in files: settle this frame first") from error


def keep_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row key is not in ``dropped``; same columns."""
    names = docs.columns
    marked = with_row(docs, F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    return marked.join(dropped.select(*ROW), ROW, "left_anti").select("row.*")
