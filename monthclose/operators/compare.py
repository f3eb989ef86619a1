"""Comparison of two results by key: reconciliation, month over month, and membership.

All of them add up per key before anything is shuffled, so a key that holds a large part of the rows costs
one row per task, and no key ever yields pairs of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.functions.casts import total


def reconcile(
    a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, threshold: float = 1
) -> DataFrame:
    """Per key the value on either side and the difference, where it is above the threshold.

    A missing side counts as 0, and NULL keys match each other. This is a full outer join with
    null-safe keys, written as one aggregation over both sides: grouping is null-safe already, needs
    one exchange of partial sums instead of two and a sort, and works on rows not yet added up too.
    """
    amount = F.col(f"`{value}`")
    zero = F.lit(0).cast(dict(a.dtypes)[value])
    columns = [F.col(f"`{k}`") for k in keys]
    both = a.select(*columns, amount.alias("_a"), zero.alias("_b")).unionAll(
        b.select(*columns, zero.alias("_a"), amount.alias("_b"))
    )
    sums = both.groupBy(*columns).agg(
        F.coalesce(total(F.col("_a")), F.lit(0)).alias("val_a"),
        F.coalesce(total(F.col("_b")), F.lit(0)).alias("val_b"),
    )
    diff = F.col("val_a") - F.col("val_b")
    return sums.withColumn("diff", diff).where(F.abs("diff") > threshold)


def largest_first(diffs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order differences by size; the keys break ties, so that equal sizes do not share one task."""
    return diffs.orderBy(F.abs("diff").desc(), *[F.col(f"`{k}`") for k in keys])


def full_join_null_safe(
    a: DataFrame, b: DataFrame, keys: Sequence[str], values_a: Sequence[str], values_b: Sequence[str]
) -> DataFrame:
    """Full outer join in which NULL keys match, for results that are unique per key.

    ``<=>`` stays an equality for the planner, so this is a sort-merge join.
    """
    left = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *values_a)
    right = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *values_b)
    same = [left[f"_a_{k}"].eqNullSafe(right[f"_b_{k}"]) for k in keys]
    joined = left.join(right, reduce(lambda x, y: x & y, same), "full")
    return joined.select(
        *[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], *values_a, *values_b
    )


def month_change(
    current: DataFrame, previous: DataFrame, key: str, value: str, how: str = "full"
) -> DataFrame:
    """This month against the last one, both unique per key: value, earlier value and change.

    NULL keys do not match. When both sides were just grouped by the key, the join uses their
    partitioning and adds no exchange.
    """
    a = current.select(F.col(key).alias("_ka"), F.col(value).alias("_va"))
    b = previous.select(F.col(key).alias("_kb"), F.col(value).alias("_vb"))
    joined = a.join(b, F.col("_ka") == F.col("_kb"), how)
    now, before = F.coalesce("_va", F.lit(0)), F.coalesce("_vb", F.lit(0))
    if how == "left":
        return joined.select(
            F.col("_ka").alias(key), F.col("_va").alias("cur"), F.col("_vb").alias("prev"),
            (F.col("_va") - before).alias("chg"),
        )
    return joined.select(
        F.coalesce("_ka", "_kb").alias(key), now.alias("cur"), before.alias("prev"),
        (now - before).alias("chg"),
    )


def totals_where_key_in(
    rows: DataFrame, key: str, allowed: DataFrame, sums: dict[str, Column]
) -> DataFrame:
    """Totals of the rows whose key occurs in ``allowed`` (its first column).

    ``sums`` are sum or count aggregates. They are formed per key first, and then over the keys kept:
    a hot key is one row when it meets the other side, and the semi join keeps the partitioning.
    """
    per_key = rows.groupBy(key).agg(*[c.alias(name) for name, c in sums.items()])
    wanted = allowed.select(F.col(allowed.columns[0]).alias(key)).distinct()
    return per_key.join(wanted, key, "left_semi").agg(
        *[F.sum(name).alias(name) for name in sums]
    )


def rows_where_key_in(rows: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """The rows whose key occurs in ``allowed`` (its first column)."""
    wanted = allowed.select(F.col(allowed.columns[0]).alias(key))
    return rows.join(wanted, key, "left_semi")
