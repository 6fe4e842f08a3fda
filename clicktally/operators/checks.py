"""Checks of rows against the contract of their table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.schemas import TableContract


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or lack a part, with how often and the reason."""
    lacking = reduce(or_, (F.col(name).isNull() for name in key))
    return (
        rows.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .withColumn(
            "reason",
            F.when(lacking, "null in key").when(F.col("rows") > 1, "repeated key"),
        )
        .filter(F.col("reason").isNotNull())
    )


def width_violations(rows: DataFrame, contract: TableContract) -> DataFrame:
    """One row per text that is longer than its column allows."""
    too_long = [
        (name, width, F.length(name) > width)
        for name, width in contract.widths.items()
        if name in rows.columns
    ]
    found = F.array_compact(
        F.array(
            *(
                F.when(
                    test,
                    F.struct(
                        F.lit(name).alias("column"),
                        F.lit(width).alias("width"),
                        F.length(name).alias("length"),
                    ),
                )
                for name, width, test in too_long
            )
        )
    )
    return rows.filter(reduce(or_, (test for _, _, test in too_long))).select(
        *contract.key, F.inline(found)
    )


def contract_violations(rows: DataFrame, contract: TableContract) -> DataFrame:
    """The keys of rows that break the contract of their table, each once, with the reasons.

    A row with too long a text, a key that occurs more than once and one that lacks a part count.
    """
    found = [key_violations(rows, contract.key).select(*contract.key, "reason")]
    if any(name in rows.columns for name in contract.widths):
        wide = width_violations(rows, contract)
        reason = F.concat(F.lit("too long: "), F.col("column"))
        found.append(wide.select(*contract.key, reason.alias("reason")))
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy(*contract.key)
        .agg(F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reason"))
    )


def split_by_contract(
    rows: DataFrame, contract: TableContract
) -> tuple[DataFrame, DataFrame]:
    """The rows whose key keeps the contract, and the others with the reason."""
    broken = contract_violations(rows, contract).alias("b")
    same = reduce(
        and_, (F.col(f"r.{name}").eqNullSafe(F.col(f"b.{name}")) for name in contract.key)
    )
    held = rows.alias("r")
    return (
        held.join(broken, same, "left_anti"),
        held.join(broken, same).select("r.*", "b.reason"),
    )


class ContractViolation(ValueError):
    """Rows do not fit the table they are written to."""


def require_contract(rows: DataFrame, contract: TableContract) -> None:
    """Raise with a few examples where rows break the key or a width of their table."""
    examples = contract_violations(rows, contract).take(5)
    if examples:
        raise ContractViolation(f"{contract.name}: violations, e.g. {examples}")
