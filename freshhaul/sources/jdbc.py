"""JDBC reads with the subquery pushed to the database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def known_ids_query(table: str, column: str = "event_id") -> str:
    return f"(SELECT DISTINCT {column} FROM {table} WHERE {column} IS NOT NULL) ids"


def id_parts(column: str, parts: int) -> list[str]:
    """Conditions that share the ids out: each id meets exactly one, whatever its type."""
    part = f"mod(abs(hashtext(CAST({column} AS text))::bigint), {parts})"
    return [f"{part} = {number}" for number in range(parts)]


def read_known_ids(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str],
    column: str = "event_id",
    parts: int = 16,
) -> DataFrame:
    """Distinct ids of a table, read by ``parts`` tasks with a query each."""
    return spark.read.jdbc(
        url=url, table=known_ids_query(table, column), predicates=id_parts(column, parts), properties=props
    )


def read_table(
    spark: SparkSession, url: str, table: str, props: dict[str, str]
) -> DataFrame:
    return spark.read.jdbc(url=url, table=table, properties=props)
