"""Structured Streaming over landed snapshot files.

* ``stream_snapshots``: file source with an explicit schema -> exactly-once file sink;
  each landed file is processed once thanks to the checkpoint (``availableNow`` runs
  drain everything landed so far and stop, which is what a scheduled job wants).
* ``dedup_within_watermark``: drop repeats of the same key arriving late, with state
  bounded by the watermark delay.
* ``latest_snapshot`` / ``latest_per_key``: keep the newest poll / the newest row per key
  (batch operators; they also run on the stream's sink table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.operators.ranking import argmax_global
from contrail.schemas import CORRUPT_COL, with_corrupt
from contrail.sources.snapshots import JSON_OPTIONS


def snapshot_stream(spark: SparkSession, landing: str, schema: T.StructType,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(with_corrupt(schema))
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT_COL)
         .options(**JSON_OPTIONS))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing)


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], ts_col: str, delay: str) -> DataFrame:
    """Drop rows whose ``keys`` were already seen within ``delay`` of event time.

    Watermarks need a TIMESTAMP column; a TIMESTAMP_NTZ event time is read as UTC.
    """
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        wm = "_event_time"
        df = df.withColumn(wm, F.to_utc_timestamp(F.col(ts_col), "UTC"))
        return df.withWatermark(wm, delay).dropDuplicatesWithinWatermark(list(keys)).drop(wm)
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def _drain(q: StreamingQuery, timeout_sec: float | None) -> StreamingQuery:
    """Wait until everything landed is processed; a time limit only where the caller sets one."""
    if timeout_sec is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_sec):
        q.stop()
        raise TimeoutError(f"stream did not drain within {timeout_sec}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def run_to_sink(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                timeout_sec: float | None = None) -> StreamingQuery:
    """Start ``df`` into an exactly-once file sink with ``availableNow`` and wait for it."""
    q = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(sink))
    return _drain(q, timeout_sec)


def run_to_sink_batches(df: DataFrame, fn, checkpoint: str, timeout_sec: float | None = None) -> StreamingQuery:
    """``foreachBatch`` variant of :func:`run_to_sink` (``availableNow``, checkpointed)."""
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return _drain(q, timeout_sec)


def stream_snapshots(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                     required: Sequence[str] = (), dedup_keys: Sequence[str] | None = None,
                     ts_col: str | None = None, delay: str = "2 hours",
                     max_files_per_trigger: int | None = None, quarantine: str | None = None,
                     timeout_sec: float | None = None) -> StreamingQuery:
    """Landed JSON -> (optional watermark de-dup) -> Parquet sink. Bad rows go to ``quarantine``
    (``<sink>_quarantine`` by default) with a checkpoint of their own."""
    s = snapshot_stream(spark, landing, schema, max_files_per_trigger)
    bad = F.col(CORRUPT_COL).isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    run_to_sink(s.where(bad), quarantine or f"{sink.rstrip('/')}_quarantine", f"{checkpoint.rstrip('/')}_quarantine",
                timeout_sec=timeout_sec)
    s = s.where(~bad).drop(CORRUPT_COL)
    if dedup_keys:
        s = dedup_within_watermark(s, dedup_keys, ts_col, delay)
    return run_to_sink(s, sink, checkpoint, timeout_sec=timeout_sec)


def latest_snapshot(df: DataFrame, ts_col: str = "snapshot_ts") -> DataFrame:
    """Rows of the newest poll only (global max of the poll time, ties = the whole poll)."""
    return argmax_global(df, ts_col)


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, ts_col: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (largest ``(ts, *tiebreak)``, then the other columns, so the choice is always the
    same), as a ``max_by`` aggregate: partial aggregation keeps one candidate per key per task, so
    a hot key is not gathered (the struct makes it a sort aggregate)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts_col), *[F.col(c) for c in tiebreak], *[F.col(c) for c in rest if c != ts_col and c not in tiebreak])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)
