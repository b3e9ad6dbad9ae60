"""Result tables in a relational database: staged rows and one merge statement run by the database."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame


def merge_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Insert staged rows; overwrite the non-key columns where the key exists."""
    listed = ", ".join(columns)
    updates = ", ".join(f"{name} = VALUES({name})" for name in columns if name not in keys)
    return f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} ON DUPLICATE KEY UPDATE {updates}"


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    execute: Callable[[str], None],
    options: Mapping[str, str] | None = None,
    writers: int = 8,
    staging: str | None = None,
) -> None:
    """Write `df` over JDBC to a staging table with at most `writers` connections, then let `execute` run the merge.

    Repeating it leaves the same rows. Two writers of one table at a time need `staging` names of their own.
    """
    staging = staging or f"{table}_staging"
    writer = df.repartition(writers).write.format("jdbc").option("url", url).option("dbtable", staging)
    writer.option("truncate", "true").options(**(options or {})).mode("overwrite").save()
    execute(merge_statement(table, staging, df.columns, keys))
