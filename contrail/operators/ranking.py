"""Ranking: ties-kept argmax (global and per group), top-N per group, top-1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.operators.joins import one_row


def order_columns(cols: Sequence[str | Column]) -> list[Column]:
    """Sort keys from names ('-name' = descending, NULLs last; ascending puts NULLs first)."""
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        elif c.startswith("-"):
            out.append(F.col(c[1:]).desc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_first())
    return out


def argmax_global(df: DataFrame, col: str) -> DataFrame:
    """All rows whose ``col`` equals the global maximum (ties kept, NULLs never match).

    The maximum is a global aggregate (partial per task, one row at the end) broadcast
    back into an equi-join; nothing is collected to the driver and no single-partition
    window is used.
    """
    mx = df.agg(F.max(col).alias("_max")).where(F.col("_max").isNotNull())
    # NULL-safe equality against a non-NULL maximum selects the same rows as ``=``, but
    # keeps Catalyst from inferring ``col IS NOT NULL`` and pushing a (possibly costly)
    # computed ``col`` below its projection into the scan or an earlier join.
    return df.join(one_row(mx), F.col(col).eqNullSafe(F.col("_max")), "inner").drop("_max")


def argmax_by_group(df: DataFrame, col: str, by: Sequence[str] | str, method: str = "join") -> DataFrame:
    """Rows whose ``col`` equals the maximum of their group (ties kept).

    ``join`` (default, any input): group maxima come from an aggregate and are joined back
    on (group, value); the join key includes the value, so a hot group is spread over many
    partitions. Group keys compare NULL-safe (a NULL group is a group, as in a window).
    ``window``: ``rank() == 1`` per group; for inputs whose groups are bounded (e.g. an
    aggregate keyed by a dimension), it avoids evaluating ``df`` twice.
    """
    by = [by] if isinstance(by, str) else list(by)
    if method == "window":
        w = Window.partitionBy(*by).orderBy(F.col(col).desc())
        return df.where(F.col(col).isNotNull()).withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    mx = df.groupBy(*by).agg(F.max(col).alias("_max")).where(F.col("_max").isNotNull())
    mx = mx.select(*[F.col(b).alias(f"_k_{b}") for b in by], "_max")
    cond = F.col(col).eqNullSafe(F.col("_max"))  # see argmax_global
    for b in by:
        cond = cond & df[b].eqNullSafe(F.col(f"_k_{b}"))
    return df.join(mx, cond, "inner").drop("_max", *[f"_k_{b}" for b in by])


def top_n_per_group(df: DataFrame, by: Sequence[str] | str, order: Sequence[str | Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number() <= n`` per group with a total order ('-col' = descending).

    Planned with ``WindowGroupLimit``: each task keeps only its local top ``n`` per group
    before the shuffle, so a hot group ships ``n`` rows per task.
    """
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order_columns(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top1(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """First row by a total order (``TakeOrderedAndProject``: a per-task top-1, then one merge)."""
    return df.orderBy(*order_columns(order)).limit(1)
