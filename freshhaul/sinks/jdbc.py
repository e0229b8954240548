"""JDBC writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str]) -> None:
    df.write.jdbc(url=url, table=table, mode="append", properties=props)


def stage_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str]) -> None:
    """Replace the staging table that a database-side merge reads."""
    df.write.jdbc(url=url, table=table, mode="overwrite", properties=props)


def merge_statement(target: str, staging: str, columns: list[str], key: str, changed_on: str) -> str:
    """Upsert from staging, for a database with INSERT ... ON CONFLICT."""
    listed = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return (
        f"INSERT INTO {target} ({listed}, updated_at) "
        f"SELECT {listed}, CURRENT_TIMESTAMP FROM {staging} "
        f"ON CONFLICT ({key}) DO UPDATE SET {updates}, updated_at = CURRENT_TIMESTAMP "
        f"WHERE {target}.{changed_on} IS DISTINCT FROM EXCLUDED.{changed_on}"
    )


def prune_statement(table: str, hours: float, column: str = "event_time") -> str:
    return f"DELETE FROM {table} WHERE {column} < CURRENT_TIMESTAMP - INTERVAL '{hours} hours'"


def execute(spark: SparkSession, url: str, statements: list[str], props: dict[str, str]) -> None:
    """Run statements in one transaction over the JDBC driver the session has loaded."""
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for name, value in props.items():
        login.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    finally:
        connection.close()
