"""SimHash near-dedup with pigeonring candidate filtering.

A text's fingerprint has bit b set when over half of its shingle hashes have it. Two
fingerprints link at ``max_distance`` (t) or fewer differing bits.

Candidates: the 64 bits are m = 2t + 1 segments in a ring. If two fingerprints differ in at
most t bits, some start exists from which every chain of l consecutive segments differs in
at most floor(l * t / m) bits. For l = 1, 2 that budget is 0, so two consecutive segments
are equal: they are the equi-join key. Longer chains are checked against their budgets on
the joined pair, and only survivors see the full Hamming check.

Scale: texts shuffle nowhere; equal fingerprints are reduced to one node before any join;
a bucket (start, two segments) with more than ``max_bucket`` different fingerprints is not
paired but resolved exactly by centres: two members differ in at most t bits if and only if
some value within t / 2 bits of both exists, so each member goes to all values within t / 2
bits of it (only bits outside the key, at most 52) and all members of a value are linked to
its smallest one. Such a group has at most as many members as there are masks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, field
from contrail.llm.graph import components

BITS = 64


def simhash64(text: str | None, shingle: int = 3, chunk: int = 1 << 16) -> int:
    """Signed 64-bit fingerprint; no words (or NULL): 0. Memory is bounded by ``chunk``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:n].tolist()
    end = (end[shingle - 1:] if len(words) >= shingle else end[-1:]).tolist()
    text_bytes, digest = b" ".join(words), xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, chunk):
        raw = b"".join([digest(text_bytes[i:j], 42) for i, j in zip(start[k:k + chunk], end[k:k + chunk])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row (id, fp long) per input row."""
    def run(batches):
        for b in batches:
            fp = [simhash64(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"{field(docs, id_col, 'id')}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(max_distance: int) -> list[int]:
    """Bit masks of the ring's 2t + 1 segments, from the highest bits down."""
    m, left, out = 2 * max_distance + 1, BITS, []
    for j in range(m):
        width = (left + m - j - 1) // (m - j)
        left -= width
        out.append(((1 << width) - 1) << left)
    return out


def within_budgets(x: Column, start: Column, max_distance: int) -> Column:
    """Pigeonring check of the differing bits ``x``: all chains from ``start`` stay within budget."""
    masks = segments(max_distance)
    m, cases = len(masks), None
    for i in range(m):
        ok, mask = F.lit(True), 0
        for length in range(1, m + 1):
            mask |= masks[(i + length - 1) % m]
            if length > 2:  # the key already makes the first two segments equal
                ok = ok & (F.bit_count(x.bitwiseAND(F.lit(_signed(mask)))) <= length * max_distance // m)
        cases = F.when(start == i, ok) if cases is None else cases.when(start == i, ok)
    return cases


def links(nodes: DataFrame, max_distance: int = 2, max_bucket: int = 64) -> DataFrame:
    """(fp, node) with different fps -> edges (u, v) that connect exactly the fps linked at
    ``max_distance`` or fewer bits (within an oversized bucket through its smallest members)."""
    if max_distance < 0:
        raise ValueError("max_distance must not be negative")
    if not max_distance:  # different fingerprints are never linked
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).where(F.lit(False))
    # Two fingerprints within t bits have a centre within floor(t / 2) of one and ceil(t / 2) of the other.
    close, far = max_distance // 2, (max_distance + 1) // 2
    masks = segments(max_distance)
    m = len(masks)
    pair = [masks[i] | masks[(i + 1) % m] for i in range(m)]
    keys = F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(_signed(p))).alias("key"))
                     for i, p in enumerate(pair)])
    seg = nodes.select("fp", "node", F.explode(keys).alias("k")).select("fp", "node", "k.start", "k.key")
    sizes = seg.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(seg.join(sizes, ["start", "key"]), "simhash-buckets")
    small = shared.where(F.col("n") <= max_bucket)
    a, b = small.alias("a"), small.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = (a.join(b, (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key"))
                    & (F.col("a.node") < F.col("b.node")))
             .where(within_budgets(x, F.col("a.start"), max_distance))
             .where(F.bit_count(x) <= max_distance)
             .select(F.col("a.node").alias("u"), F.col("b.node").alias("v")))
    near = None
    for i, p in enumerate(pair):
        free = [1 << k for k in range(BITS) if not p >> k & 1]
        flips = [_signed(sum(c)) for r in range(far + 1) for c in combinations(free, r)]
        lit = F.array(*[F.lit(f).cast("long") for f in flips])
        near = F.when(F.col("start") == i, lit) if near is None else near.when(F.col("start") == i, lit)
    stars = (shared.where(F.col("n") > max_bucket)
             .select("node", "start", "fp", F.explode(near).alias("flip"))
             .groupBy("start", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
             .agg(F.collect_list("node").alias("members"), F.min(F.when(F.bit_count("flip") <= close, F.col("node"))).alias("u"))
             .where(F.col("u").isNotNull() & (F.size("members") > 1))
             .select("u", F.explode("members").alias("v")).where("u != v"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 2, max_bucket: int = 64) -> DataFrame:
    """(id, fingerprint, component_id) for every input row; component_id is the smallest id
    reachable over links.

    Ids are whole numbers. Defined cases: NULL, empty or blank texts have fingerprint 0 and
    link like any other; repeated rows come out as often as they went in; a NULL id keeps its
    row, joins its fingerprint's component, and where a component has no id at all
    component_id is NULL; an empty table gives an empty result. Only the two named columns
    are read, so extra columns cannot clash.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle), "simhash")
    # Fingerprints are the nodes: one whose rows have no id links like any other.
    nodes = fps.groupBy("fp").agg(F.min("id").alias("id"))
    roots = components(links(nodes.select("fp", F.col("fp").alias("node")), max_distance, max_bucket))
    named = cut(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "id"), "simhash-roots")
    by_fp = named.select("fp", "root").join(named.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns kept.

    Rows that repeat id and text come out once. An id on different texts keeps each of them that
    its component keeps; rows without an id all stay, since nothing names them (a text once)."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_distance)
    keep = found.where(F.col(id_col).isNull() | (F.col(id_col) == F.col("component_id"))).select(F.col(id_col).alias("__keep")).distinct()
    kept = docs.join(keep, docs[id_col].eqNullSafe(keep["__keep"]), "left_semi")
    return kept.dropDuplicates([id_col, text_col])
