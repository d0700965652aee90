"""The polling loop as a stream: every landed poll becomes one scheduled run.

A collector lands JSON-lines files, one or several per poll of the live feed. ``stream_runs``
reads the landing folder with Structured Streaming (each file once, thanks to the
checkpoint). A micro-batch is parsed once; one write puts its good rows below their polls, a
part per landed file, so a file that is read again (a replay, a new checkpoint) replaces its own
rows and another file of the poll adds to them.

A ledger of empty files below ``<base>/_polls`` says which polls are open, closed, or have a
failed dataset. A poll closes when a poll later by more than ``close_after`` has landed, at the
latest at the end of the drain; then the pipeline runs for it once, over all its files. Rows that
come after that are counted as late and open the poll again. A dataset that failed is tried again
by the next drain. Every effect is a replaced folder or an empty file, so a micro-batch replayed
after a failure changes nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from contrail import schemas as SCH
from contrail.functions.columns import RUN_COLUMNS, run_columns
from contrail.operators.clean import normalise_sentinels
from contrail.plans.job import STATUS_SCHEMA, Inputs, run
from contrail.schemas import CORRUPT_COL
from contrail.sources.layers import RUN_ID, VERSION, delete, exists, layer_path, names_in, publish, read_run, run_id, run_path, \
    run_time, touch, write_layer
from contrail.streaming.ingest import run_to_sink_batches, snapshot_stream

PART = "part"
OPEN_FILES = 4  # a split of a landed file has rows of one poll or a few
POLL_STATUS = T.StructType([T.StructField("poll", T.StringType()), *STATUS_SCHEMA.fields])


class Ledger:
    """Which polls are open, closed or have failed datasets: empty files named by run id."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.home = spark, f"{base.rstrip('/')}/_polls"

    def add(self, state: str, name: str) -> None:
        touch(self.spark, f"{self.home}/{state}/{name}")

    def drop(self, state: str, name: str) -> None:
        delete(self.spark, f"{self.home}/{state}/{name}")

    def has(self, state: str, name: str) -> bool:
        return exists(self.spark, f"{self.home}/{state}/{name}")

    def names(self, state: str) -> list[str]:
        return [n for n in names_in(self.spark, f"{self.home}/{state}") if not n.startswith(".")]

    def failed(self) -> dict[str, list[str]]:
        """Failed datasets by poll."""
        out: dict[str, list[str]] = {}
        for name in self.names("failed"):
            poll, dataset = name.split(".")
            out.setdefault(poll, []).append(dataset)
        return out


def _land_batch(spark: SparkSession, batch: DataFrame, base: str, poll_col: str) -> list[tuple[dt.datetime, int]]:
    """Bronze and quarantine rows of one micro-batch; returns its polls with their rows."""
    stage = f"{base.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    batch.write.parquet(stage)  # the one pass over the landed JSON
    # The stream's own session: a task keeps a few files open and sorts its rows only if they go to more.
    batch.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    staged = batch.sparkSession.read.schema(batch.schema).parquet(stage)
    bad = F.col(CORRUPT_COL).isNotNull() | F.col("id").isNull() | F.col(poll_col).isNull()
    write_layer(staged.where(bad), layer_path(base, "quarantine", "flights"), partition_cols=[PART])

    version, flights_path = uuid.uuid4().hex, layer_path(base, "bronze", "flights")
    good = staged.where(~bad).drop(CORRUPT_COL)
    micros = F.date_format(poll_col, "SSSSSS")
    named = F.concat(F.date_format(poll_col, "yyyyMMdd'T'HHmmss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("_"), micros)))
    below = {**run_columns(F.col(poll_col)), RUN_ID: named, VERSION: F.lit(version)}
    (normalise_sentinels(good, [f.name for f in SCH.FLIGHTS.fields if f.dataType == T.StringType()]).withColumns(below)
     .write.mode("append").partitionBy(*RUN_COLUMNS, RUN_ID, PART, VERSION).parquet(flights_path))
    touched = good.groupBy(poll_col, PART).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per poll and file of the batch
    for r in touched:
        publish(spark, f"{run_path(flights_path, r[poll_col])}/{PART}={r[PART]}", version)
    delete(spark, stage)
    polls: dict[dt.datetime, int] = {}
    for r in touched:
        polls[r[poll_col]] = polls.get(r[poll_col], 0) + r["n"]
    return sorted(polls.items())


def stream_runs(spark: SparkSession, landing: str, dims: Inputs, base: str, checkpoint: str,
                datasets: Sequence[str] | None = None, gold_formats: Sequence[str] = ("csv",),
                poll_col: str = "snapshot_ts", max_files_per_trigger: int | None = None,
                timeout_sec: float | None = None, close_after: dt.timedelta = dt.timedelta(0), flush: bool = True) -> DataFrame:
    """Drain the landing folder (``availableNow``): one pipeline run per landed poll. Returns ``poll, layer,
    dataset, rows, status``: the status rows of the runs made, and the late rows of polls opened again (layer ``late``).

    Rows that are malformed, have no id or no poll time go to ``<base>/quarantine/flights``, below the
    file they stand in. Without ``flush`` a poll that no later one has closed stays open for the next
    drain. Polls run one after the other; their number and the time of the drain are not limited
    (``timeout_sec`` sets a limit).
    """
    ledger, said = Ledger(spark, base), []
    flights_path = layer_path(base, "bronze", "flights")

    def run_poll(poll: str, wanted: Sequence[str] | None) -> None:
        ts = run_time(poll)
        flights = read_run(spark, flights_path, ts, SCH.FLIGHTS, parts=True)
        rows = run(spark, Inputs(flights, dims.airlines, dims.airports, dims.zones, dims.models), base, ts,
                   gold_formats=gold_formats, datasets=wanted, bronze_tables=("airline_bridge",)).collect()
        said.extend((poll, *r) for r in rows)
        for r in rows:
            if r.layer == "bronze":
                continue
            ok = not any(s.dataset == r.dataset and s.status.startswith(("failed", "missing")) for s in rows)
            if not ok:
                ledger.add("failed", f"{poll}.{r.dataset}")
            elif ledger.has("failed", f"{poll}.{r.dataset}"):
                ledger.drop("failed", f"{poll}.{r.dataset}")

    def close(polls: Iterable[str]) -> None:
        for poll in polls:
            run_poll(poll, datasets)
            ledger.add("closed", poll)
            ledger.drop("open", poll)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        for ts, n in _land_batch(spark, batch, base, poll_col):
            poll = run_id(ts)
            if ledger.has("closed", poll):
                said.append((poll, "late", "flights", n, "ok"))
            ledger.add("open", poll)
        still_open = ledger.names("open")
        if still_open:
            seen = max(run_time(p) for p in still_open)
            close(p for p in still_open if run_time(p) + close_after < seen)

    for poll, names in ledger.failed().items():
        if not ledger.has("open", poll):
            run_poll(poll, names)
    stream = snapshot_stream(spark, landing, SCH.FLIGHTS, max_files_per_trigger)
    in_parts = stream.withColumn(PART, F.hex(F.xxhash64(F.col("_metadata.file_path"))))
    run_to_sink_batches(in_parts, per_batch, checkpoint, timeout_sec)
    if flush:
        close(ledger.names("open"))
    return spark.createDataFrame(said, POLL_STATUS)
