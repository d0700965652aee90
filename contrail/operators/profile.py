"""Data profile of a run from the write itself: one Observation counts per column what is missing or odd.

No second scan: the counts and quantiles are metrics of the write. They are stored per run (a row per
column and metric), so a run is compared with the last one without reading either's rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from contrail.functions.columns import SENTINELS
from contrail.sources.layers import last_run_before, read_run, write_run

PROFILE = T.StructType([T.StructField("column", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])
QUANTILES = (0.25, 0.5, 0.75)
Ranges = Mapping[str, tuple[float | None, float | None]]


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def profile_metrics(schema: T.StructType, ranges: Ranges | None = None, quantiles: Sequence[float] = QUANTILES) -> list[tuple[str, str, Column]]:
    """(column, metric, aggregate): ``rows``; per column ``nulls``; of texts ``sentinels``; of doubles ``nans``; of numbers
    ``quantiles`` (NULL and NaN left out); ``out_of_range`` of the columns in ``ranges`` (lowest and highest good value)."""
    out = [("*", "rows", F.count(F.lit(1)))]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        out.append((f.name, "nulls", _count(c.isNull())))
        if isinstance(f.dataType, T.StringType):
            out.append((f.name, "sentinels", _count(F.trim(c).isin(*SENTINELS))))
        real = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        if real:
            out.append((f.name, "nans", _count(F.isnan(c))))
        if isinstance(f.dataType, T.NumericType):
            sound = F.when(~F.isnan(c), c) if real else c
            out.append((f.name, "quantiles", F.percentile_approx(sound.cast("double"), list(quantiles))))
        low, high = (ranges or {}).get(f.name, (None, None))
        odd = [c < low] * (low is not None) + [c > high] * (high is not None)
        if odd:
            out.append((f.name, "out_of_range", _count(odd[0] if len(odd) == 1 else odd[0] | odd[1])))
    return out


def profiled_write(df: DataFrame, path: str, profile_path: str, run_ts: dt.datetime | str, ranges: Ranges | None = None,
                   quantiles: Sequence[float] = QUANTILES) -> int:
    """Publish ``df`` as a run of ``path`` and its profile as a run of ``profile_path``; returns the rows written."""
    metrics = profile_metrics(df.schema, ranges, quantiles)
    seen = Observation(f"profile_{uuid.uuid4().hex}")
    write_run(df.observe(seen, *[m.alias(f"m{i}") for i, (_, _, m) in enumerate(metrics)]), path, run_ts)
    rows = []
    for i, (column, metric, _) in enumerate(metrics):
        value = seen.get[f"m{i}"]
        if metric == "quantiles":
            rows += [(column, f"p{100 * q:g}", v) for q, v in zip(quantiles, value or [None] * len(quantiles))]
        else:
            rows.append((column, metric, float(value)))
    write_run(df.sparkSession.createDataFrame(rows, PROFILE).coalesce(1), profile_path, run_ts)
    return int(seen.get["m0"])


def profile_change(spark: SparkSession, profile_path: str, run_ts: dt.datetime | str) -> DataFrame:
    """``column, metric, before, now``: a run's profile beside the last run's (NULL where one of them lacks the metric)."""
    now = read_run(spark, profile_path, run_ts, PROFILE).withColumnRenamed("value", "now")
    last = last_run_before(spark, profile_path, run_ts, PROFILE)
    if last is None:
        return now.select("column", "metric", F.lit(None).cast("double").alias("before"), "now")
    return now.join(last.withColumnRenamed("value", "before"), ["column", "metric"], "full").select("column", "metric", "before", "now")
