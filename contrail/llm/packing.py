"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens (its documents one after the other). A window of
``window`` tokens gives every queue that still has tokens a quantum in proportion to its
target weight; what a queue is owed beyond whole tokens (its deficit) is carried into the
next window. When a queue runs dry inside a window, the others share what it leaves, and
later windows are dealt among them. Windows follow each other without gaps and are cut into
sequences, so only the very last sequence is not full.

The rounds between two queues running dry are closed-form: after r rounds the queues up to j
have been served floor(r * W * (w_1 + ... + w_j) + carry), which keeps every deficit below one
token and makes any window computable on its own. So the driver replays only the windows in
which a queue runs dry (at most one per queue), and each task cuts its own documents knowing
nothing but where they start in their queue. Tokens are made once, written, and never shuffled
by key; offsets are prefix sums over (task, source) totals, not over documents.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import cut, field, free_name

#: The pre-tokenizer pattern of the public byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of() -> dict[str, int]:
    """The byte each printable stand-in character of a byte-level vocabulary means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str, added_tokens: bool = False):
    """A function text -> uint32 ids for the byte-level BPE file at ``path``; one per process.

    The file's merges are in order of their results' ids, so the ids are merge ranks and the
    rank-based encoder gives the same ids several times faster (checked by a test against the
    file's own library). With ``added_tokens`` the string of an added token of the file in a text
    is that token's id, as the file's tokenizer has it; without, it is ordinary text. A text that the
    rank encoder's pattern refuses (a run of about a million blanks) goes to the file's own tokenizer.
    """
    import tiktoken
    known = tiktoken.registry.ENCODINGS  # lives as long as the worker
    if path not in known:
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        added = {t["content"]: t["id"] for t in d.get("added_tokens", [])}
        to_byte = byte_of()
        ranks = {bytes(to_byte[c] for c in t): i for t, i in d["model"]["vocab"].items() if t not in added}
        known[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    e, allowed = known[path], "all" if added_tokens else set()

    def encode(t: str) -> np.ndarray:
        try:
            return np.asarray(e.encode_to_numpy(t, allowed_special=allowed, disallowed_special=()), np.uint32)
        except ValueError:  # its stack is too small for the text
            from tokenizers import Tokenizer
            own = Tokenizer.from_file(path)
            own.encode_special_tokens = not added_tokens
            return np.array(own.encode(t, add_special_tokens=False).ids, np.uint32)

    return encode


def tokenized(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, source_col: str, added_tokens: bool = False) -> DataFrame:
    """(id, source, tokens, ids, part, start): ids with the closing 0, ``start`` the tokens of the
    same source before it in the same task. Written once."""
    def run(batches):
        part, encode, at = TaskContext.get().partitionId(), encoder(vocabulary, added_tokens), {}
        zero = np.zeros(1, np.uint32)
        for b in batches:
            ids, n, start = [], [], []
            for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                x = np.concatenate([encode(t or ""), zero])
                ids.append(x.astype(np.uint16 if x.max() < 1 << 16 else np.uint32).tobytes())
                n.append(len(x))
                start.append(at.get(s, 0))
                at[s] = start[-1] + len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([part] * len(n), pa.int64()), pa.array(start, pa.int64())],
                ["id", "source", "tokens", "ids", "part", "start"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(source_col).cast("string").alias("s"))
    return cut(rows.mapInArrow(run, f"{field(docs, id_col, 'id')}, source string, tokens long, ids binary, part long, start long"),
               "packing-tokens")


#: Boundaries and carries count in 2^-20 tokens: whole numbers, alike in every task.
SHIFT = 20
ONE = 1 << SHIFT


def _served(boundary: int, owed: int, rounds: int) -> int:
    return (boundary * rounds + owed >> SHIFT) - (owed >> SHIFT)


class Schedule:
    """The deal of all windows, as stretches of rounds with the same queues.

    A stretch is (first window, rounds, first global token, per queue: tokens served before,
    cumulative boundaries c_j, carries). ``tokens`` are the queues' lengths, ``weights`` their
    targets.
    """

    def __init__(self, tokens: list[int], weights: list[int], window: int):
        self.window, self.stretches = window, []
        served, carry, at = [0] * len(tokens), [0] * len(tokens), 0
        while at < sum(tokens):
            live = [j for j, n in enumerate(tokens) if served[j] < n]
            # A quantum of over two tokens after scaling, so that no slice can run backwards.
            share = [max(weights[j], -(-3 * sum(weights[i] for i in live) // window)) for j in live]
            total, c, owed = sum(share), [0], [0]
            for j, w in zip(live, accumulate(share)):
                c.append((window * w << SHIFT) // total)
                owed.append(owed[-1] + carry[j])
            owed[-1] = 0
            given = lambda r: [_served(c[k + 1], owed[k + 1], r) - _served(c[k], owed[k], r) for k in range(len(live))]  # noqa: E731, B023
            left = [tokens[j] - served[j] for j in live]
            lo, hi = 0, sum(left) // window + 1
            while lo < hi:  # the most rounds in which nobody runs dry
                mid = (lo + hi + 1) // 2
                lo, hi = (mid, hi) if all(g <= n for g, n in zip(given(mid), left)) else (lo, mid - 1)
            if lo:
                self.stretches.append((lo, at, live, [served[j] for j in live], c, owed, None))
                for j, g, k in zip(live, given(lo), range(len(live))):
                    served[j] += g
                    carry[j] = (c[k + 1] * lo + owed[k + 1]) % ONE - (c[k] * lo + owed[k]) % ONE
                at += lo * window
                continue
            take, carry = self._dry_window(live, share, left, carry)
            self.stretches.append((1, at, live, [served[j] for j in live], None, None, take))
            for j, q in zip(live, take):
                served[j] += q
            at += sum(take)
        self.total = at
        self.queues = [[] for _ in tokens]  # per queue: (tokens served before, stretch, position)
        for s, (_, _, live, before, *_) in enumerate(self.stretches):
            for k, j in enumerate(live):
                self.queues[j].append((before[k], s, k))

    def _dry_window(self, live: list[int], share: list[int], left: list[int], carry: list[int]) -> tuple[list[int], list[int]]:
        """One window in which some queue runs dry: (tokens per live queue, new carries). What dry queues
        leave is dealt again among the others by their shares; fractions of tokens stay owed."""
        take, owed, rest, room = [0] * len(live), [0] * len(carry), list(range(len(live))), min(self.window, sum(left))
        while rest:
            total = sum(share[k] for k in rest)
            dry = [k for k in rest if room * share[k] // total >= left[k]]
            if not dry:
                break
            for k in dry:
                take[k] = left[k]
            room -= sum(left[k] for k in dry)
            rest = [k for k in rest if not take[k] or take[k] < left[k]]
        for k in rest:
            quota = (room * share[k] << SHIFT) // total
            take[k], owed[live[k]] = quota >> SHIFT, quota % ONE + carry[live[k]]
        spare = room - sum(take[k] for k in rest)
        for k in sorted(rest, key=lambda k: (-owed[live[k]], k))[:spare]:
            take[k] += 1
            owed[live[k]] = max(0, owed[live[k]] - ONE)
        return take, [x % ONE for x in owed]

    def slices(self, queue: int, start: int, length: int):
        """(start in queue, length, global position) of the slices that hold these tokens."""
        own = self.queues[queue]
        i, end = bisect_right(own, start, key=lambda x: x[0]) - 1, start + length
        while start < end:
            before, s, k = own[i]
            rounds, at, _, _, c, owed, quantum = self.stretches[s]
            stop = min(end, own[i + 1][0]) if i + 1 < len(own) else end
            if quantum is not None:
                if stop > start:
                    yield start, stop - start, at + sum(quantum[:k]) + start - before
                    start = stop
            else:
                low = lambda r: _served(c[k], owed[k], r)  # noqa: E731, B023
                got = lambda r: _served(c[k + 1], owed[k + 1], r) - low(r)  # noqa: E731, B023
                r = (start - before << SHIFT) // (c[k + 1] - c[k])
                while got(r) > start - before:
                    r -= 1
                while got(r + 1) <= start - before:
                    r += 1
                while start < stop:
                    done, after = got(r), got(r + 1)
                    n = min(stop, before + after) - start
                    if n > 0:
                        # Within a window: the boundaries of the queues before it, then this queue's slice.
                        yield start, n, at + r * self.window + low(r + 1) - low(r) + start - before - done
                        start += n
                    r += 1
            i += 1


def scaled(raw: list[float], scale: int = 1 << 20) -> list[int]:
    """Weights as whole numbers of at least one."""
    whole = sum(raw) or 1.0
    return [max(1, round(scale * x / whole)) for x in raw]


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         sequence: int = 1024, window: int = 65536, targets: dict | None = None, exponent: float = 0.7,
         max_queues: int = 256, with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """One row per piece: id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and, with ``with_ids``, the piece's ids as little-endian uint32). ``added_tokens``: as for
    ``encoder``.

    A source's target weight is the one in ``targets`` (sources without one: their share of tokens),
    without ``targets`` its token share to the power ``exponent`` (below 1 flattens the mixture).
    The ``max_queues`` largest sources have a queue each. The others are dealt in two levels: groups
    of sources that run dry about together are queues of the driver's schedule with their summed
    weights (at most ``max_queues`` of them), and tasks deal a group's tokens among its sources by
    the same closed form and their own weights. Defined cases: a NULL or empty text is the
    single id 0; a NULL source is a source of its own; repeated rows are packed as often as
    they come; an empty table gives no pieces. Extra columns are not read.
    """
    rows = tokenized(docs, vocabulary, id_col, text_col, source_col, added_tokens)
    sums = rows.groupBy("source", "part").agg(F.sum("tokens").alias("n"))
    big = sums.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("source")).limit(max_queues)
    named = {r["source"]: k for k, r in enumerate(big.collect())}
    rest = len(named)

    by_queue = F.create_map(*[x for s, k in named.items() if s is not None for x in (F.lit(s), F.lit(k))]) if any(s is not None for s in named) else None
    queue = F.lit(named.get(None, rest)) if by_queue is None else F.when(
        F.col("source").isNull(), F.lit(named.get(None, rest))).otherwise(F.coalesce(F.try_element_at(by_queue, F.col("source")), F.lit(rest)))
    sums = sums.withColumn("queue", queue.cast("int"))
    # Where each (source, part) starts in its source: prefix sums over the tasks' totals.
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(sums.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-bases")
    lengths = {r[0]: r[1] for r in bases.groupBy("queue").agg(F.sum("n")).collect()}
    all_tokens = sum(lengths.values()) or 1
    power = 1.0 if targets else exponent
    lone = [j for j in sorted(lengths) if j != rest]
    names = {k: s for s, k in named.items()}
    tokens = [lengths[j] for j in lone]
    raw = [(targets or {}).get(names[j], (lengths[j] / all_tokens) ** power) for j in lone]
    order, pools = {q: j for j, q in enumerate(lone)}, rest in lengths
    if pools:
        weight = F.pow(F.col("n") / all_tokens, F.lit(power))
        given = [x for s, w in (targets or {}).items() if s is not None and s not in named for x in (F.lit(s), F.lit(float(w)))]
        if given:
            weight = F.coalesce(F.try_element_at(F.create_map(*given), F.col("source")), weight)
        if None in (targets or {}):
            weight = F.when(F.col("source").isNull(), F.lit(float(targets[None]))).otherwise(weight)
        pooled = bases.where(F.col("queue") == rest).groupBy("source").agg(F.sum("n").alias("n")).withColumn("w", weight)
        ranked = cut(pooled.orderBy(F.col("n") / F.greatest("w", F.lit(1e-12)), "source").withColumn("at", F.monotonically_increasing_id()), "packing-pooled")
        task = F.shiftright("at", 33)  # the id is (task, place in the task): its rank is exact
        counts = sorted(tuple(r) for r in ranked.groupBy(task).count().collect())
        before = accumulate((n for _, n in counts), initial=0)
        rank = F.try_element_at(F.create_map(*[F.lit(x) for (p, _), n in zip(counts, before) for x in (p, n)]), task) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        size = max(max_queues, -(-sum(n for _, n in counts) // max_queues))
        placed = ranked.withColumn("rank", rank)
        members = placed.select("source", (F.lit(rest) + F.floor(F.col("rank") / size)).cast("int").alias("group"), (F.col("rank") % size).alias("member"), "n", "w")
        groups = cut(members.groupBy("group").agg(F.sum("n").alias("tokens"), F.sum("w").alias("w"), F.array_sort(F.collect_list(F.struct("member", "n", "w"))).alias("members")),
                     "packing-groups")
        for g, n, w in sorted(tuple(r) for r in groups.select("group", "tokens", "w").collect()):
            order[g] = len(tokens)
            tokens.append(n)
            raw.append(w)
        m, here = members.select("source", "group", "member").alias("m"), bases.alias("b")
        bases = cut(here.join(m, (F.col("b.queue") == rest) & F.col("b.source").eqNullSafe(F.col("m.source")), "left")
                    .select("b.source", "b.part", "b.base", F.coalesce("m.group", "b.queue").alias("queue"), "m.member"), "packing-members")
    plan = Schedule(tokens, scaled(raw), window)

    def slices(b, i, inner, at, length, queue):
        member = b.column("member")[i].as_py() if pools else None
        if member is None:
            yield from plan.slices(order[queue], at, length)
            return
        if queue not in inner:
            if len(inner) > 15:
                inner.clear()
            own = b.column("members")[i].as_py()
            inner[queue] = Schedule([x["n"] for x in own], scaled([x["w"] for x in own]), window)
        for start, n, place in inner[queue].slices(member, at, length):
            for first, k, where in plan.slices(order[queue], place, n):
                yield start + first - place, k, where

    def cut_up(batches):
        inner = {}
        for b in batches:
            col = {n: [] for n in ("row", "start", "length", "crc", "seq", "off", "raw")}
            for i, (raw, tokens, at, q) in enumerate(zip(b.column("ids").to_pylist(), b.column("tokens").to_pylist(),
                                                         b.column("at").to_pylist(), b.column("queue").to_pylist())):
                wide = raw if len(raw) == 4 * tokens else np.frombuffer(raw, np.uint16).astype("<u4").tobytes()
                last = None
                for start, length, place in slices(b, i, inner, at, tokens, q):
                    start -= at
                    while length:
                        n = min(length, sequence - place % sequence)
                        if last == place and place % sequence:  # goes on where the last piece ended
                            col["length"][-1] += n
                            lo = 4 * col["start"][-1]
                        else:
                            for key, v in (("row", i), ("start", start), ("length", n), ("crc", 0), ("seq", place // sequence), ("off", place % sequence), ("raw", None)):
                                col[key].append(v)
                            lo = 4 * start
                        piece = wide[lo:4 * (start + n)]
                        col["crc"][-1] = zlib.crc32(piece)
                        if with_ids:
                            col["raw"][-1] = piece
                        start, length, place = start + n, length - n, place + n
                        last = place
            row = pa.array(col["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(row), b.column("source").take(row), pa.array(col["start"], pa.int64()), pa.array(col["length"], pa.int64()),
                 pa.array(col["crc"], pa.int64()), b.column("tokens").take(row), pa.array(col["seq"], pa.int64()), pa.array(col["off"], pa.int64()),
                 *([pa.array(col["raw"], pa.binary())] if with_ids else [])],
                ["id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])])

    placed = (rows.alias("r").join(bases.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.part") == F.col("b.part")))
              .select("r.id", "r.source", "r.ids", "r.tokens", (F.col("r.start") + F.col("b.base")).alias("at"), "b.queue", *(["b.member"] if pools else [])))
    if pools:
        # The groups are stored, so Spark knows their size: it broadcasts them while they are small.
        placed = placed.join(groups.select(F.col("group").alias("queue"), "members"), "queue", "left")
    out = placed.mapInArrow(cut_up, f"{field(docs, id_col, 'id')}, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                    f"sequence_id long, offset long{', ids binary' if with_ids else ''}")
    return out.withColumnRenamed("id", free_name([c for c in out.columns if c != "id"], id_col))
