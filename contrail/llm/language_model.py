"""Deleted interpolation: bigram, unigram and uniform estimates mixed by context frequency.

p(w | v) = a_b * c(v w) / c(v) + u_b * c(w) / N + z_b / (V + 1), where b is the bucket (by
powers of two) of the context's count. The weights of a bucket are learned by expectation-
maximisation: maximum-likelihood estimates come from the retained training fold, the tokens
they are judged on from the held-out one. Scores then use the counts of all training rows.

Work: each task turns its texts into blocks of at most ``block_tokens`` tokens (or one longer
text) and sends, per shard of the hash space, the block's different n-grams once, sorted, with
their counts. A shard adds the counts of all blocks and answers each block for the n-grams it
asked about; a block then has the corpus counts of all its tokens and scores its rows. So both
shuffles move one entry per different n-gram of a block, never one per token and count, and no
model table is ever held in one place. Every n-gram of all training rows counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import crc_fold, cut, field

GRAIN = 8  # log2 grid of the estimates' ratios in the held-out table: steps of 1/8
ROW = "kind string, shard int, block long, a binary, b binary, c binary, d binary, n long"
ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("block", pa.int64()), ("a", pa.binary()),
                   ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("n", pa.int64())])


def planes(x: np.ndarray) -> bytes:
    """Compressed bytes of whole numbers: all first bytes, then all second bytes, ..."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes(), 1)


def unplanes(raw: bytes, kind) -> np.ndarray:
    raw = zstandard.decompress(raw)
    size = np.dtype(kind).itemsize
    n = len(raw) // size
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def counted(x: np.ndarray) -> bytes:
    """Compressed counts: four bytes each, eight where one of them needs more."""
    wide = len(x) and int(x.max()) >> 32
    return (b"8" if wide else b"4") + planes(x.astype(np.uint64 if wide else np.uint32))


def uncounted(raw: bytes) -> np.ndarray:
    return unplanes(raw[1:], np.uint64 if raw[:1] == b"8" else np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), ARROW)], schema=ARROW) if rows else \
        pa.RecordBatch.from_arrays([pa.array([], k.type) for k in ARROW], schema=ARROW)


class Block:
    """Token sequences of some rows: local word numbers (0 is the end of a text, and as a context
    its start), fold per token and the different n-grams with their hashes."""

    END = xxhash.xxh64_intdigest(b"\n", 7)  # no word is a line feed

    def __init__(self, id_type: pa.DataType):
        self.id_type, self.words, self.tokens, self.rows, self.size = id_type, {b"\n": 0}, [], [], 0

    def add(self, row: tuple, text: str | None) -> None:
        number = self.words
        ids = [number.setdefault(w, len(number)) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]
        ids.append(0)
        self.tokens.append(np.array(ids, np.uint32))
        self.rows.append((*row, len(ids)))
        self.size += len(ids)

    def requests(self, block: int, shards: int):
        """The block's own row (to be sent along) and one row per shard that it asks."""
        token = np.concatenate(self.tokens)
        fold = np.repeat(np.array([r[1] for r in self.rows], np.uint8), [r[2] for r in self.rows])
        hashes = mix(np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in self.words), np.uint64, len(self.words)))
        by_hash = np.argsort(hashes, kind="stable").astype(np.uint32)
        self.words, self.tokens = {}, []
        for kind in "wp":
            if kind == "w":
                value, own, order = token, hashes, by_hash
            else:
                pair, value = pairs_of(token, len(hashes))
                own = pair_hashes(pair, hashes)
                del pair
                order = np.argsort(own, kind="stable")
            h = own[order]
            retained = np.bincount(value[fold == 1], minlength=len(h)).astype(np.uint32)[order]
            held = np.bincount(value[fold == 2], minlength=len(h)).astype(np.uint32)[order]
            shard = ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            bounds = np.searchsorted(shard, np.arange(shards + 1))
            for s in np.unique(shard).tolist():
                lo, hi = bounds[s], bounds[s + 1]
                yield (kind, s, block, planes(np.diff(h[lo:hi], prepend=np.uint64(0))), planes(retained[lo:hi]), planes(held[lo:hi]),
                       int(lo).to_bytes(8, "little"), hi - lo)
        docs = pa.RecordBatch.from_arrays([pa.array([r[0] for r in self.rows], self.id_type), pa.array([r[1] for r in self.rows], pa.int32()),
                                           pa.array([r[2] for r in self.rows], pa.int64())], ["id", "fold", "n"])
        yield ("b", block % shards, block, planes(token), planes(by_hash), None, as_bytes(docs), len(hashes))


def pairs_of(token: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Different (context, word) pairs as context * words + word, and the pair of each token."""
    context = np.concatenate([np.zeros(1, np.uint32), token[:-1]])
    return np.unique(context.astype(np.int64) * words + token, return_inverse=True)


def pair_hashes(pair: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    n = len(hashes)
    return mix(hashes[pair // n] * np.uint64(3) + mix(hashes[pair % n] + np.uint64(1)))


def as_bytes(b: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, b.schema) as w:
        w.write_batch(b)
    return out.getvalue().to_pybytes()


def ask(shards: int, block_tokens: int):
    def run(batches):
        part, count, block = TaskContext.get().partitionId(), 0, None
        for b in batches:
            block = block or Block(b.schema.field(0).type)
            for key, fold, text in zip(*(b.column(k).to_pylist() for k in range(3))):
                block.add((key, fold), text)
                if block.size >= block_tokens:
                    for r in block.requests(part << 32 | count, shards):
                        yield batch([r])
                    count, block = count + 1, Block(block.id_type)
        if block and block.size:
            for r in block.requests(part << 32 | count, shards):
                yield batch([r])
    return run


def answer(key, table):
    """All requests to one shard -> the corpus counts for each request, and the shard's totals."""
    rows, out = table.to_pylist(), []
    for kind in "wp":
        asked = [r for r in rows if r["kind"] == kind]
        if not asked:
            continue
        hashes = [np.cumsum(unplanes(r["a"], np.uint64), dtype=np.uint64) for r in asked]
        different, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros((2, len(different)), np.int64)
        for k, c in enumerate("bc"):
            np.add.at(total[k], at, np.concatenate([unplanes(r[c], np.uint32) for r in asked]))
        lo = 0
        for r in asked:
            mine = at[lo:lo + r["n"]]
            lo += r["n"]
            out.append((kind, r["shard"], r["block"], counted(total[0][mine]), counted(total[1][mine]),
                        r["a"] if kind == "w" else None, r["d"], r["n"]))
        if kind == "w":
            known = (total.sum(axis=0) > 0).sum()
            out.append(("s", 0, -1, int(known).to_bytes(8, "little"), int(total[0].sum()).to_bytes(8, "little"),
                        int(total[1].sum()).to_bytes(8, "little"), None, 0))
    out += [tuple(r[f.name] for f in ARROW) for r in rows if r["kind"] == "b"]
    return pa.Table.from_batches([batch(out)])


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).astype(np.int64)


def gather(key, table):
    """A block and the answers to it -> the block with its n-grams' corpus counts (one row)."""
    rows = table.to_pylist()
    if rows[0]["kind"] == "s":
        return table
    own = next(r for r in rows if r["kind"] == "b")
    token, by_hash = unplanes(own["a"], np.uint32), unplanes(own["b"], np.uint32)
    hashes = np.zeros(len(by_hash), np.uint64)
    for r in rows:
        if r["kind"] == "w":  # the block's word hashes come back with the answers
            lo = int.from_bytes(r["d"], "little")
            hashes[by_hash[lo:lo + r["n"]]] = np.cumsum(unplanes(r["c"], np.uint64), dtype=np.uint64)
    pair, _ = pairs_of(token, len(hashes))
    order = {"w": by_hash, "p": np.argsort(pair_hashes(pair, hashes), kind="stable")}
    count = {}
    for kind, o in order.items():
        got = [(int.from_bytes(r["d"], "little"), r["n"], uncounted(r["a"]), uncounted(r["b"])) for r in rows if r["kind"] == kind]
        count[kind] = np.zeros((2, len(o)), np.result_type(np.uint32, *(x.dtype for g in got for x in g[2:])))
        for lo, n, retained, held in got:
            count[kind][:, o[lo:lo + n]] = retained, held
    return pa.Table.from_batches([batch([("b", own["shard"], own["block"], own["a"], counted(count["p"].reshape(-1)), counted(count["w"].reshape(-1)), own["d"], own["n"])])])


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """(pair of each token, six counts per pair, rows): counts of the pair, its context and its
    word, first in the retained, then in the held-out fold."""
    pair, at = pairs_of(unplanes(row["a"], np.uint32), row["n"])
    p, w = uncounted(row["b"]).reshape(2, -1), uncounted(row["c"]).reshape(2, -1)
    first, second = pair // row["n"], pair % row["n"]
    six = np.stack([p[0], w[0][first], w[0][second], p[1], w[1][first], w[1][second]]).astype(np.float64)
    with pa.ipc.open_stream(row["d"]) as r:
        return at, six, r.read_all()


def held_out_table(tokens: int, words: int):
    """Per block: held-out tokens by (bucket, log ratio of bigram and of unigram to uniform)."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                at, six, d = opened(row)
                fold = np.repeat(d.column("fold").to_numpy(), d.column("n").to_numpy())
                n = np.bincount(at[fold == 2], minlength=six.shape[1])
                with np.errstate(divide="ignore", invalid="ignore"):
                    two = np.round(GRAIN * np.log2(six[0] / six[1] * (words + 1)))
                    one = np.round(GRAIN * np.log2(six[2] / max(1, tokens) * (words + 1)))
                codes = np.stack([bucket(six[1]), np.where(six[0] > 0, two, -9999), np.where(six[2] > 0, one, -9999)]).astype(np.int64)[:, n > 0]
                got, back = np.unique(codes, axis=1, return_inverse=True)
                sums = np.bincount(back.reshape(-1), weights=n[n > 0], minlength=got.shape[1])
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in got), pa.array(sums.astype(np.int64))], ["bucket", "two", "one", "n"])
    return run


def learn(cells: list[tuple[int, int, int, int]], rounds: int = 200, precision: float = 1e-7) -> dict[int, np.ndarray]:
    """EM per bucket -> weights (bigram, unigram, uniform). Buckets without held-out tokens take
    the nearest bucket's below (the unseen bucket: unigram and uniform alone)."""
    weights = {}
    for b in sorted({c[0] for c in cells}):
        own = np.array([c[1:] for c in cells if c[0] == b], np.float64)
        n, ratio = own[:, 2], np.where(own[:, :2] <= -9999, 0, 2.0 ** (own[:, :2] / GRAIN))
        p = np.column_stack([ratio, np.ones(len(own))])
        w = np.array([0 if b == 0 else 1, 1, 1], np.float64)
        w /= w.sum()
        for _ in range(rounds):
            share = p * w
            new = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            done = np.abs(new - w).max() < precision
            w = new
            if done:
                break
        w = np.maximum(w, [0 if b == 0 else 1e-6, 1e-6, 1e-6])
        weights[b] = w / w.sum()
    return weights


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, unseen_fold: int = 1,
           tuning_fold: int = 2, block_tokens: int = 2_000_000, shard_bytes: int = 24 << 20) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Rows whose crc fold is ``unseen_fold`` are never learned from; those of ``tuning_fold`` are
    the held-out counts of the interpolation weights (and count in the final estimates).
    Ids may have any type; counts are exact up to 2^63. Defined cases: NULL and empty texts are one end token; a NULL id folds as the empty text;
    repeated rows count and come out as often as they are there; with no training rows every
    estimate is uniform over one unknown word; an empty table gives an empty result.
    Extra columns are not read.
    """
    fold = crc_fold(id_col, folds)
    rows = docs.select(F.col(id_col).alias("id"), F.when(fold == unseen_fold, 0).when(fold == tuning_fold, 2).otherwise(1).alias("fold"),
                       F.col(text_col).alias("t"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    asked = rows.mapInArrow(ask(shards, block_tokens), ROW)
    answered = asked.groupBy("shard").applyInArrow(answer, ROW)
    resolved = cut(answered.groupBy("block").applyInArrow(gather, ROW), "lm-blocks")
    known = [r for r in resolved.where("kind = 's'").select("a", "b", "c").toLocalIterator()]
    value = lambda k: sum(int.from_bytes(r[k], "little") for r in known)
    words, retained, total = value(0), value(1), value(1) + value(2)
    blocks = resolved.where("kind = 'b'")
    cells = (blocks.mapInArrow(held_out_table(retained, words), "bucket long, two long, one long, n long")
             .groupBy("bucket", "two", "one").agg(F.sum("n")).collect())
    weights = learn([tuple(c) for c in cells]) or {0: np.array([0, .5, .5])}
    unseen = weights.get(0, np.array([0, .5, .5]))

    def run(batches):
        known = np.array(sorted(weights), np.int64)
        table = np.array([weights[b] for b in known])
        for b in batches:
            for row in b.to_pylist():
                at, six, d = opened(row)
                pair, context, word = six[0] + six[3], six[1] + six[4], six[2] + six[5]
                w = table[np.maximum(0, np.searchsorted(known, bucket(context), "right") - 1)]
                w = np.where((context > 0)[:, None], w, unseen)
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(total, 1) + w[:, 2] / (words + 1)
                base = np.log10((word + 0.5) / (total + 0.5 * (words + 1)))
                start = np.concatenate([[0], np.cumsum(d.column("n").to_numpy())[:-1]]).astype(np.int64)
                add = lambda x: np.add.reduceat(x[at], start)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [d.column("id").combine_chunks(), pa.array(d.column("fold").to_numpy() == 0), d.column("n").combine_chunks(),
                     pa.array(add((word > 0).astype(np.int64))), pa.array(np.full(len(start), total, np.int64)),
                     pa.array(add(base)), pa.array(add(np.log10(p)))],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.mapInArrow(run, f"{field(docs, id_col, 'id')}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double") \
        .withColumnRenamed("id", id_col)
