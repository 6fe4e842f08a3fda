"""Sinks in databases."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.operators.checks import require_contract
from clicktally.schemas import TableContract
from clicktally.session import delete_path, fresh_path

# Connections that a write opens at most.
CONNECTIONS = 16


def _as_stored(rows: DataFrame, contract: TableContract) -> DataFrame:
    """Rows in the column order of their table, counts as the int of its definition."""
    return rows.select(
        *(
            F.col(field.name).cast("int").alias(field.name)
            if isinstance(field.dataType, T.LongType)
            else F.col(field.name)
            for field in contract.schema
        )
    )


@contextmanager
def _checked(rows: DataFrame, contract: TableContract) -> Iterator[DataFrame]:
    """Rows that keep the contract of their table, stored so that they are computed once.

    The copy is deleted when the block ends.
    """
    spark = rows.sparkSession
    stored = fresh_path(spark, contract.name)
    try:
        rows.select(*contract.columns).write.parquet(stored)
        rows = spark.read.schema(contract.schema).parquet(stored)
        require_contract(rows, contract)
        yield _as_stored(rows, contract)
    finally:
        delete_path(spark, stored)


def append_rows(
    rows: DataFrame,
    url: str,
    contract: TableContract,
    properties: dict[str, str],
    connections: int = CONNECTIONS,
) -> None:
    """Append to a table by JDBC, after checking keys and widths.

    Tasks commit on their own, so a failed append can leave some rows behind: use
    :func:`upsert_rows` where that matters.
    """
    with _checked(rows, contract) as checked:
        checked.write.option("numPartitions", connections).jdbc(
            url, contract.name, mode="append", properties=properties
        )


def staging_table(contract: TableContract) -> str:
    """The table beside a result table that takes the rows of an upsert first."""
    return f"{contract.name}_staging"


def upsert_statement(contract: TableContract, changed: Sequence[str], dialect: str) -> str:
    """One insert-or-update from the staging table; all names come from the contract."""
    names = ", ".join(contract.columns)
    staged = staging_table(contract)
    insert = f"INSERT INTO {contract.name} ({names}) SELECT {names} FROM {staged}"
    if dialect == "mysql":
        updates = ", ".join(f"{name} = {staged}.{name}" for name in changed)
        return f"{insert} ON DUPLICATE KEY UPDATE {updates}"
    if dialect == "postgresql":
        updates = ", ".join(f"{name} = excluded.{name}" for name in changed)
        conflict = f"ON CONFLICT ({', '.join(contract.key)}) DO UPDATE SET {updates}"
        # Without a condition the grammar would take the conflict for one of a join.
        return f"{insert} WHERE true {conflict}"
    raise ValueError(f"unknown dialect {dialect!r}")


def upsert_rows(
    rows: DataFrame,
    url: str,
    execute: Callable[[str], None],
    contract: TableContract,
    changed: Sequence[str],
    properties: dict[str, str],
    dialect: str = "mysql",
    connections: int = CONNECTIONS,
) -> None:
    """Insert or update rows: by JDBC into a staging table, then from there in one statement.

    ``execute`` runs a statement in the database and commits it. The staging table is made anew each
    time, so a run that died before the statement has changed nothing, and one can be repeated.
    """
    statement = upsert_statement(contract, changed, dialect)
    with _checked(rows, contract) as checked:
        checked.write.option("numPartitions", connections).jdbc(
            url, staging_table(contract), mode="overwrite", properties=properties
        )
    execute(statement)
