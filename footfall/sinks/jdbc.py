"""Day results into a SQL table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _run(connection: Any, sql: str, *bound: str) -> None:
    statement = connection.prepareStatement(sql)
    try:
        for i, value in enumerate(bound):
            statement.setString(i + 1, value)
        statement.executeUpdate()
    finally:
        statement.close()


def swap_day(connection: Any, table: str, staging: str, columns: list[str], day: str) -> None:
    """Delete the day and take over the staged rows of that day in one transaction."""
    names = ", ".join(columns)
    committed = connection.getAutoCommit()
    connection.setAutoCommit(False)
    try:
        _run(connection, f"DELETE FROM {table} WHERE day = ?", day)
        _run(connection, f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE day = ?", day)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.setAutoCommit(committed)


def driver_connection(spark: SparkSession, url: str, properties: dict[str, str]) -> Any:
    jvm_properties = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        jvm_properties.setProperty(key, value)
    return spark._jvm.java.sql.DriverManager.getConnection(url, jvm_properties)


def replace_day(
    rows: DataFrame,
    url: str,
    table: str,
    day: str,
    properties: dict[str, str],
    connect: Callable[[SparkSession, str, dict[str, str]], Any] = driver_connection,
) -> None:
    """Replace one day of a SQL table.

    Executors load the rows into a staging table of this run; only the statements of
    the swap run from the driver, so the table goes from the old day to the new at once
    and a failed load leaves it alone. The staging table is dropped either way.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    connection = connect(rows.sparkSession, url, properties)
    try:
        rows.write.mode("errorifexists").jdbc(url, staging, properties=properties)
        swap_day(connection, table, staging, rows.columns, day)
    finally:
        try:
            _run(connection, f"DROP TABLE IF EXISTS {staging}")
        finally:
            connection.close()
