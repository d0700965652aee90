"""Scalar column helpers: run (partition) columns and sentinel normalisation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Text the feed uses for "no value".
SENTINELS = ("N/A", "NaN", "None", "")

RUN_COLUMNS = ("tech_year", "tech_month", "tech_day", "tech_hour")


def run_columns(ts: Column) -> dict[str, Column]:
    """Partition columns in the kata's naming: year, ``YYYY-MM``, date, hour."""
    return {
        "tech_year": F.year(ts).cast("int"),
        "tech_month": F.date_format(ts, "yyyy-MM"),
        "tech_day": F.to_date(ts),
        "tech_hour": F.hour(ts).cast("int"),
    }


def run_ts_literal(run_ts: dt.datetime | str) -> Column:
    """One timestamp for every table of a run (a run over midnight stays in one partition)."""
    if isinstance(run_ts, dt.datetime):
        run_ts = run_ts.replace(tzinfo=None).isoformat(sep=" ")
    # From text: independent of the driver's and the session's time zone.
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def nullify_sentinel(c: Column, sentinels=SENTINELS) -> Column:
    """Map sentinel text (after trimming) to NULL; other values pass unchanged."""
    return F.when(F.trim(c).isin(*sentinels), F.lit(None).cast("string")).otherwise(c)


def nullify_nan(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def is_present(c: Column, dtype: str) -> Column:
    """True when a value is neither NULL, NaN (doubles) nor sentinel text (strings)."""
    if dtype in ("double", "float"):
        return c.isNotNull() & ~F.isnan(c)
    if dtype == "string":
        return c.isNotNull() & ~F.trim(c).isin(*SENTINELS)
    return c.isNotNull()
