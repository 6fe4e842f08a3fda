"""Insert-or-update of one DataFrame by another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _equal(left: Column, right: Column) -> Column:
    """Equality where nulls equal each other, in a form that is not taken as a join key."""
    return F.coalesce(left == right, left.isNull() & right.isNull())


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    changed: Sequence[str],
    code: str | None = None,
) -> DataFrame:
    """``target`` with ``updates`` applied; both hold a key at most once.

    A row whose key is in ``updates`` takes the ``changed`` columns from there and keeps all
    others; new keys are added whole; the rest stays. Presence is told by markers, since a
    null may be data, also in a key, where it equals another null. Applying the same updates again
    changes nothing.

    ``code`` names a column of both that is made from the key and never null. They are then joined by it
    alone and the key is compared afterwards, so a target that is stored in buckets of it stays in place.
    """
    held = target.withColumn("held", F.lit(True)).alias("t")
    new = updates.withColumn("new", F.lit(True)).alias("u")
    if code is None:
        same = reduce(and_, (F.col(f"t.{name}").eqNullSafe(F.col(f"u.{name}")) for name in key))
    else:
        compared = (_equal(F.col(f"t.{name}"), F.col(f"u.{name}")) for name in key)
        same = reduce(and_, compared, F.col(f"t.{code}") == F.col(f"u.{code}"))
    joined = held.join(new, same, "full_outer")
    columns = []
    for name in target.columns:
        if name in changed and name not in key:
            columns.append(
                F.when(F.col("new"), F.col(f"u.{name}"))
                .otherwise(F.col(f"t.{name}"))
                .alias(name)
            )
        else:
            columns.append(
                F.when(F.col("held"), F.col(f"t.{name}"))
                .otherwise(F.col(f"u.{name}"))
                .alias(name)
            )
    return joined.select(*columns)
