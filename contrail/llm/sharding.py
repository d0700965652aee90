"""Sharding by histogram sort: equal bytes per shard, one exchange.

Rows are ordered by (hash of the text, id), so copies of a text lie side by side and sources
mix. The splitters of that order are found without moving a row: each round counts the exact
bytes and rows below a few candidate boundaries per splitter (one narrow aggregate over all
partitions), keeps the bracket around each target, and probes finer inside it until every
splitter is within tolerance or its bracket cannot shrink. Then rows are exchanged once.

A shard is cut into ``ranges`` of about ``range_rows`` rows by splitters of their own, so that
neither the sort nor the slot numbering ever sees a whole shard: a slot is the exact number
of rows below its range (known from the histogram) plus the rank within the range.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import cut, free_name
from contrail.session import fresh_path

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """(key, tie, size) of every row, after the columns in ``keep``."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    return docs.select(*keep, F.xxhash64(t).alias("key"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LOW)).alias("tie"),
                       (F.octet_length(t) + 1).cast("long").alias("size"))


def _below(key: np.ndarray, tie: np.ndarray, probes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each row the number of probes (sorted pairs) at or below it."""
    pk, pt = probes
    lo, hi = np.searchsorted(pk, key, "left"), np.searchsorted(pk, key, "right")
    out = lo.copy()
    for a in np.unique(lo[lo < hi]):  # rows whose key is a probe's key: the tie decides
        rows = (lo == a) & (hi > a)
        out[rows] = a + np.searchsorted(pt[a:hi[rows][0]], tie[rows], "right")
    return out


def histogram(rows: DataFrame, probes: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact (bytes, rows) below each probe. Every task sends one row per interval it has; the
    driver gets at most one row per probe and one more, in a single job."""
    pk, pt = (np.array(x, np.int64) for x in zip(*probes))

    def run(batches):
        for b in batches:
            at = _below(b.column(0).to_numpy(), b.column(1).to_numpy(), (pk, pt))
            size = b.column(2).to_numpy()
            got, back = np.unique(at, return_inverse=True)
            total = np.zeros(len(got), np.int64)
            np.add.at(total, back, size)
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64()), pa.array(total), pa.array(np.bincount(back, minlength=len(got)).astype(np.int64))],
                                             ["at", "bytes", "n"])

    found = rows.select("key", "tie", "size").mapInArrow(run, "at long, bytes long, n long")
    got = found.groupBy("at").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).toArrow()
    bins = np.zeros((2, len(probes) + 1), np.int64)
    bins[:, got.column("at").to_numpy()] = [got.column("bytes").to_numpy(), got.column("n").to_numpy()]
    return tuple(x.tolist() for x in bins.cumsum(axis=1)[:, :-1])


def _between(low: tuple[int, int], high: tuple[int, int], n: int, ties: tuple[int, int]) -> list[tuple[int, int]]:
    """Up to n pairs strictly between, spread over the keys, or over the ties of one key (which
    lie in ``ties``)."""
    if high[0] - low[0] > 1:
        gap = high[0] - low[0]
        return sorted({(low[0] + gap * j // (n + 1), LOW) for j in range(1, n + 1)} - {low, high})
    if high[0] > low[0] and high[1] > LOW:  # neighbouring keys: first the boundary between them
        return [(high[0], LOW)]
    first = max(low[1], ties[0])
    last = min(high[1] if high[0] == low[0] else ties[1] + 1, ties[1] + 1, HIGH)
    return sorted({(low[0], first + (last - first) * j // (n + 1)) for j in range(1, n + 1)} - {low, high, (low[0], first)}) if last > first else []


def _near(low: tuple, high: tuple, target: float, allowed: float) -> list[tuple[int, int]]:
    """Keys around the place where the target lies if bytes are spread evenly over the bracket (keys are
    hashes, so they mostly are): the place itself and half the tolerance to either side."""
    gap, span = high[0][0] - low[0][0], high[1] - low[1]
    at = [low[0][0] + int(gap * (target + d - low[1]) / span) for d in (-allowed / 2, 0, allowed / 2)] if span else []
    return [(k, LOW) for k in at if low[0] < (k, LOW) < high[0]]


def find_splitters(rows: DataFrame, parts: int, tight: int, tolerance: float = 0.002,
                   probes: int = 4096) -> tuple[list[tuple[int, int]], list[int]]:
    """``parts - 1`` splitters of equal bytes and the number of rows below each.

    Every ``tight``-th splitter (a shard's) is refined to ``tolerance`` of a shard's bytes, and all
    to a quarter of a range. A round asks about ``probes`` boundaries, or a few per
    open splitter, spread over its bracket and around its expected place; the driver holds one
    bracket per splitter and moves it by binary search among the round's boundaries.
    """
    total, count, first, last, *ties = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*"), *[
        F.coalesce(f(c), F.lit(0)) for c in ("key", "tie") for f in (F.min, F.max)]).first()
    low = [((first, LOW), 0, 0)] * (parts - 1)
    high = [((last, HIGH), total, count)] * (parts - 1)
    target = [total * (i + 1) / parts for i in range(parts - 1)]
    allowed = [min(total / parts / 4, tolerance * total * tight / parts if (i + 1) % tight == 0 else total) for i in range(parts - 1)]
    still = range(parts - 1)
    while True:
        still = [i for i in still if min(target[i] - low[i][1], high[i][1] - target[i]) > allowed[i]]
        brackets = {(low[i][0], high[i][0]) for i in still}
        each = max(3, probes // max(1, len(brackets)))
        asked = sorted({p for b in brackets for p in _between(*b, each, tuple(ties))} | {
            p for i in still for p in _near(low[i], high[i], target[i], allowed[i])})
        if not asked:
            break
        below, n = histogram(rows, asked)
        for i in still:
            at = bisect_right(below, target[i])
            if at and asked[at - 1] > low[i][0]:
                low[i] = (asked[at - 1], below[at - 1], n[at - 1])
            if at < len(asked) and asked[at] < high[i][0]:
                high[i] = (asked[at], below[at], n[at])
    best = sorted(lo if t - lo[1] <= hi[1] - t else hi for lo, hi, t in zip(low, high, target))
    return [b[0] for b in best], [b[2] for b in best]


def write_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", range_rows: int = 250_000,
                 tolerance: float = 0.002, range_bytes: int = 128 << 20, path: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Every row of ``docs`` with all its columns, written below ``path`` (by default a folder of the
    shared one) as Parquet by (shard, range), each range in the order of its slots. Returns the
    written rows and the names the added columns (slot, shard, range) got (underscored where
    ``docs`` has them).

    Sizes of shards are equal to ``tolerance`` or, where single rows are larger than that, to
    about one row. ``docs`` is read twice (for the histogram and to be moved), so it should be
    stored. Defined cases: a NULL text has no bytes (size 1), a NULL id orders first; repeated rows
    (same id and text) stay together in one range, whatever their number; with fewer rows
    than shards some shards are empty, an empty table gives an empty result.
    """
    rows = cut(sized(docs, id_col, text_col), "shard-sizes")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    per = max(4, -(-n // (shards * range_rows)), -(-total // (shards * range_bytes)))
    splitters, below = find_splitters(rows, shards * per, per, tolerance)
    pk, pt = (np.array(x, np.int64) for x in zip(*splitters))
    first = np.array([0, *below], np.int64)

    @F.pandas_udf("range long, before long")
    def range_of(key: pd.Series, tie: pd.Series) -> pd.DataFrame:
        at = _below(key.to_numpy(), tie.to_numpy(), (pk, pt))
        return pd.DataFrame({"range": at, "before": first[at] - first[at // per * per]})

    names = {}
    for k in ("slot", "shard", "range", "row"):
        names[k] = free_name([*docs.columns, *names.values()], k)
    shard, part, whole = names["shard"], names["range"], names["row"]
    placed = (sized(docs, id_col, text_col, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)])
              .withColumn("at", range_of("key", "tie")).withColumn(part, F.col("at.range"))
              .withColumn(shard, F.floor(F.col(part) / per).cast("int")))
    # Ranges are dealt in turn, so no task gets more than its share of them.
    tasks = min(shards * per, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * range_bytes))))
    task = (F.col(part) % tasks).cast("int")
    rank = F.row_number().over(Window.partitionBy("task", shard, part).orderBy("key", "tie", "size"))
    out = (placed.withColumn("task", task).repartitionById(tasks, F.col("task")).withColumn(names["slot"], F.col("at.before") + rank - 1)
           .select(f"{whole}.*", *[names[k] for k in ("slot", "shard", "range")]))
    path = path or fresh_path(docs.sparkSession, "shards")
    out.write.option("compression", "zstd").partitionBy(shard, part).parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path), names


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, size, crc, shard, slot) of every row, taken from the shards that ``write_shards`` wrote."""
    written, n = write_shards(docs, shards, id_col, text_col, **settings)
    t = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    return written.select(F.col(f"`{id_col}`"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("crc"),
                          F.col(n["shard"]).alias("shard"), F.col(n["slot"]).alias("slot"))
