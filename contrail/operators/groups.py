"""Group-level operators: flagged-group exclusion, anti join, distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def flagged_groups(df: DataFrame, group: str, flag: str = "on_ground", value=1) -> DataFrame:
    """Distinct groups having at least one row with ``flag == value`` (partial aggregate)."""
    return df.where(F.col(flag) == value).select(group).distinct()


def exclude_flagged_groups(df: DataFrame, group: str, flag: str = "on_ground", value=1) -> DataFrame:
    """Drop every row of a group that has any row with ``flag == value``.

    The group key is compared NULL-safe, so all NULL keys form one group, as a window
    partitioned by the key would. Implemented as aggregate + anti join instead of a
    window: a hot group is reduced by partial aggregation and the anti join can be split
    by AQE's skew handling, so no single task has to hold a whole group.
    """
    bad = flagged_groups(df, group, flag, value).withColumnRenamed(group, "_g")
    return df.join(bad, df[group].eqNullSafe(bad["_g"]), "left_anti")


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain ``NOT EXISTS``: rows of ``df`` without an equal key in ``other`` (NULL keys kept)."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def distinct_count_by(df: DataFrame, by: Sequence[str] | str, target: str, alias: str) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count_distinct(target).alias(alias))


def approx_distinct_count_by(df: DataFrame, by: Sequence[str] | str, target: str, alias: str,
                             rsd: float = 0.02) -> DataFrame:
    """HyperLogLog++ distinct count: fixed-size sketch per group, no exact set per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.approx_count_distinct(target, rsd).alias(alias))


# Sketches are stored, so that distinct counts over any span of runs read no facts.
LG_K = 14  # 2^14 buckets: a standard error below 1 %


def distinct_sketch_by(df: DataFrame, by: Sequence[str] | str, target: str, alias: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One HyperLogLog sketch (binary, at most 2^lg_k bytes) of ``target`` per group; NULL targets do not count."""
    by = [by] if isinstance(by, str) else list(by)
    return df.where(F.col(target).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(target, F.lit(lg_k)).alias(alias))


def merged_distinct_by(sketches: DataFrame, by: Sequence[str] | str, alias: str, sketch: str = "sketch") -> DataFrame:
    """Estimated distinct counts per group from stored sketches: their union, whatever runs they are of."""
    by = [by] if isinstance(by, str) else list(by)
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(alias))
