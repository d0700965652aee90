"""Quartile bucket digests of documents.

Every byte triplet of a text is hashed into one of ``BUCKETS`` buckets. The digest holds, for
each bucket, the quartile its count lies in (two bits), and before them the text's length on a
logarithmic scale and the ratios of the quartiles. Two digests are compared by a difference
score with an upper bound, so a likeness lies between 0 and 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import field

BUCKETS = 256
#: Difference of two buckets' quartiles, by distance: opposite quartiles count double.
STEP = np.array([0, 1, 2, 6], np.int64)
MAX_LENGTH, MAX_RATIO = 24, 16  # bounds of the header's part of the difference
SPREAD = np.uint32(2654435761)


def triplet_counts(raw: bytes, chunk: int = 1 << 20) -> np.ndarray:
    """Counts of the hashed byte triplets; memory is bounded by ``chunk``."""
    counts = np.zeros(BUCKETS, np.int64)
    b = np.frombuffer(raw, np.uint8)
    for k in range(0, max(0, len(b) - 2), chunk):
        x = b[k:k + chunk + 2].astype(np.uint32)
        code = (x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * SPREAD >> np.uint32(24)
        counts += np.bincount(code, minlength=BUCKETS)
    return counts


def fingerprint(text: str | None) -> str:
    """Hex digest: length code, two quartile ratios, 256 two-bit quartiles (4 + 128 digits).

    Texts under three bytes have no triplet: all buckets are in the lowest quartile.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = triplet_counts(raw)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, round(8 * math.log2(len(raw) + 1)))
    ratio = [int(min(15, 16 * q // (q3 + 1))) for q in (q1, q2)]
    bits = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    return bytes([length, ratio[0] << 4 | ratio[1]]).hex() + bits.tobytes().hex()


def difference(a: str, b: str) -> int:
    """Bounded difference: buckets' quartile distances, then length and ratio distances."""
    x, y = (np.frombuffer(bytes.fromhex(h), np.uint8) for h in (a, b))
    shift = np.array([[6], [4], [2], [0]], np.uint8)
    quart = np.abs((x[2:] >> shift & 3).astype(np.int64) - (y[2:] >> shift & 3))
    head = min(MAX_LENGTH, abs(int(x[0]) - int(y[0])))
    ratio = min(MAX_RATIO, abs(int(x[1] >> 4) - int(y[1] >> 4)) + abs(int(x[1] & 15) - int(y[1] & 15)))
    return int(STEP[quart].sum()) + head + ratio


MAX_DIFFERENCE = BUCKETS * int(STEP[-1]) + MAX_LENGTH + MAX_RATIO


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 at the greatest difference; unlike texts lie well below 1."""
    return max(0.0, 1.0 - difference(a, b) / (MAX_DIFFERENCE / 4))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_chars, fingerprint) per input row; no shuffle."""
    def run(batches):
        for b in batches:
            t = [x or "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(map(len, t)), pa.int64()),
                                              pa.array(list(map(fingerprint, t)), pa.string())], ["id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"{field(docs, id_col, 'id')}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def with_next(docs: DataFrame, id_col: str, text_col: str, partitions: int | None = None) -> DataFrame:
    """(range, extra, id, text) dealt by ranges of ids and sorted, each range ended by a copy of
    the rows that follow it (``extra``), after the last range the first rows of all.

    Texts are shuffled once. The ranges come from a sketch of the ids; only the range bounds
    and the first id of every range (two numbers per partition) reach the driver.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), order.alias("at"),
                       order.cast("double").alias("x"))
    bounds = sorted(set(rows.select("x").approxQuantile("x", [k / n for k in range(1, n)], 0.2 / n)))
    ranged = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="x", outputCol="b", handleInvalid="keep").transform(rows) if bounds \
        else rows.withColumn("b", F.lit(0.0))
    ranged = ranged.withColumn("range", F.col("b").cast("int")).drop("b", "x")
    firsts = sorted((r[0], r[1]) for r in ranged.groupBy("range").agg(F.min("at")).collect())
    if not firsts:
        return ranged.withColumn("extra", F.lit(False))
    # The first id of a range is also sent to the range before it (the very first one to the last).
    to = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}
    also = F.create_map(*[F.lit(x) for k, v in to.items() for x in (k, v)])
    homes = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("extra")),
                    F.struct(F.try_element_at(also, F.col("at")).alias("range"), F.lit(True).alias("extra")))
    dealt = (ranged.select("id", "text", "at", F.explode(homes).alias("h")).where("h.range is not null")
             .select("h.range", "h.extra", "id", "text", "at"))
    # Ranges are dealt in turn (they number at most ``n``): a task has one, whatever their hashes.
    return dealt.repartitionById(n, F.pmod("range", F.lit(n)).cast("int")).sortWithinPartitions("range", "extra", "at", "text")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or
    all) of the next row's text, by ascending id (repeated ids: by text), after the last row
    the first. Defined cases: NULL and empty texts are empty; a NULL id orders first; a
    single row is its own next; an empty table gives an empty result. Extra columns are not read.
    """
    dealt = with_next(docs, id_col, text_col)

    def rows(batches) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(k).to_pylist() for k in range(4)))

    def run(batches):
        out, held, size = [[] for _ in range(7)], None, 0
        for home, extra, key, text in rows(batches):
            text = text or ""
            own = fingerprint(text)
            if held is not None and held[0] == home:
                _, k, t, fp = held
                half = len(t) // 2
                edited = t[:len(t) - half] + text[:half]
                efp = fingerprint(edited)
                for c, v in zip(out, (k, len(t), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fp, efp,
                                      likeness(fp, efp), likeness(fp, own))):
                    c.append(v)
                size += 1
                if size == 5000:
                    yield batch(out)
                    out, size = [[] for _ in range(7)], 0
            held = None if extra else (home, key, text, own)
        yield batch(out)

    id_type = pa.int64() if docs.schema[id_col].dataType.simpleString() == "bigint" else None

    def batch(out):
        kinds = (id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return dealt.select("range", "extra", "id", "text").mapInArrow(
        run, f"{field(docs, id_col, 'id')}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double").withColumnRenamed("id", id_col)
