"""The newest row per key, kept up to date by a stream instead of a scan of the history.

Every micro-batch is reduced to its newest row per key and published as a small delta beside the
table; a reader takes the newest over the base and the deltas. After ``compact_every`` deltas
they are folded into a new base, which is published as a whole before the deltas go. The
stream keeps no state between batches (nothing to bound or to expire), late rows count like any
other, and a replayed batch replaces its own delta, so a restart in the middle changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from contrail.sources.layers import VERSION, delete, names_in, publish, published
from contrail.streaming.ingest import latest_per_key, run_to_sink_batches


def _put(df: DataFrame, home: str) -> None:
    version = uuid.uuid4().hex
    df.write.parquet(f"{home}/{VERSION}={version}")
    publish(df.sparkSession, home, version)


def _deltas(spark: SparkSession, table: str) -> list[str]:
    return [f"{table}/deltas/{n}" for n in names_in(spark, f"{table}/deltas") if n.startswith("batch-")]


def read_latest(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str] | str, ts_col: str,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """The table: the newest row per key over the base and the deltas."""
    # Deltas first: one that is folded into the base meanwhile is in the base read after it.
    found = [published(spark, home) for home in [*_deltas(spark, table), f"{table}/base"]]
    folders = [f for f in found if f is not None]
    if not folders:
        return spark.createDataFrame([], schema)
    return latest_per_key(spark.read.schema(schema).parquet(*folders), keys, ts_col, tiebreak)


def compact(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str] | str, ts_col: str,
            tiebreak: Sequence[str] = ()) -> None:
    """Fold the deltas into a new base. What is folded in twice after a failure changes nothing."""
    deltas = _deltas(spark, table)
    _put(read_latest(spark, table, schema, keys, ts_col, tiebreak), f"{table}/base")
    for home in deltas:
        delete(spark, home)


def stream_latest(rows: DataFrame, table: str, checkpoint: str, keys: Sequence[str] | str, ts_col: str,
                  tiebreak: Sequence[str] = (), compact_every: int = 16, timeout_sec: float | None = None) -> None:
    """Drain the stream ``rows`` (``availableNow``) into ``table``. Rows without a key or a time are not kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    schema, known = rows.schema, rows.na.drop(subset=[*keys, ts_col])

    def per_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        _put(latest_per_key(batch, keys, ts_col, tiebreak), f"{table}/deltas/batch-{epoch:012d}")
        if len(_deltas(spark, table)) >= compact_every:
            compact(spark, table, schema, keys, ts_col, tiebreak)

    run_to_sink_batches(known, per_batch, checkpoint, timeout_sec)
