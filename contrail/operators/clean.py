"""Cleaning: active filter, sentinel normalisation, NULL/NaN dropping, key uniqueness,
quarantine of corrupt rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions.columns import SENTINELS, is_present, nullify_nan, nullify_sentinel
from contrail.schemas import CORRUPT_COL


def active_flights(df: DataFrame, cols: Sequence[str] | None = None, flag: str = "on_ground") -> DataFrame:
    """Flights in the air (``on_ground == 0``), projected to ``cols``."""
    out = df.where(F.col(flag) == 0)
    return out.select(*cols) if cols else out


def normalise_sentinels(df: DataFrame, cols: Sequence[str] | None = None, sentinels=SENTINELS) -> DataFrame:
    """Replace sentinel text ('N/A', 'NaN', 'None', '') and NaN doubles by NULL."""
    types = dict(df.dtypes)
    cols = list(cols) if cols else [c for c, t in df.dtypes if t in ("string", "double", "float")]
    repl = {}
    for c in cols:
        if types[c] == "string":
            repl[c] = nullify_sentinel(F.col(c), sentinels)
        elif types[c] in ("double", "float"):
            repl[c] = nullify_nan(F.col(c))
    return df.withColumns(repl)


def drop_nullish(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with NULL, NaN or sentinel text in any column of ``subset`` (all by default)."""
    types = dict(df.dtypes)
    cols = list(subset) if subset else list(df.columns)
    cond: Column | None = None
    for c in cols:
        p = is_present(F.col(c), types[c])
        cond = p if cond is None else cond & p
    return df.where(cond) if cond is not None else df


def unique_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False) -> DataFrame:
    """One row per key: the row with the smallest (or largest) ``order`` tuple.

    Expressed as an aggregate (``min_by`` / ``max_by`` on a struct), so a hot key is
    reduced map-side by partial aggregation instead of landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if descending else F.min_by
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def zone_filter(zones: DataFrame, names: Sequence[str], col: str = "zone_name") -> DataFrame:
    return zones.where(F.col(col).isin(list(names)))


def quarantine(df: DataFrame, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split a PERMISSIVE read into (good, bad).

    Bad rows are malformed or mistyped lines (``_corrupt_record`` set) and rows missing
    a required field. Good rows lose the corrupt column.
    """
    bad_cond = _bad(df, required)
    good = df.where(~bad_cond).drop(CORRUPT_COL)
    bad = df.where(bad_cond)
    return good, bad


def quarantine_status(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Adds ``status`` = 'accepted' / 'quarantined' (same rule as :func:`quarantine`)."""
    return df.withColumn("status", F.when(_bad(df, required), "quarantined").otherwise("accepted"))


def _bad(df: DataFrame, required: Sequence[str]) -> Column:
    """Corrupt line, missing required field, or a record with no field at all.

    The last rule references every data column; the JSON reader only parses (and so only
    type-checks) the columns a query needs, so this also makes the corrupt flag cover
    every field even when the caller only counts statuses.
    """
    data = [c for c in df.columns if c != CORRUPT_COL]
    cond = F.col(CORRUPT_COL).isNotNull()
    for c in required:
        cond = cond | F.col(c).isNull()
    if data:
        cond = cond | ~F.greatest(*[F.col(c).isNotNull() for c in data], F.lit(False))
    return cond
