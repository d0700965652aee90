"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton of the test items is built in the workers, once per worker, from a block of at
most about ``block_bytes`` of items; the driver holds one block of texts at a time and no
automaton. The words of each training text stream through it: the longest match ending at each
word tells whether a window of an item ends there. A larger benchmark is matched block after
block, each in a stage of its own over the written result of the last one, so memory does not
grow with the benchmark. Training texts are never shuffled.
"""

from __future__ import annotations

import re
import sys
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, free_name

#: A-Z to a-z, other ASCII but 0-9 and a-z to space; all bytes of non-ASCII characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


class Automaton:
    """Generalised suffix automaton; matches never run across two items.

    States are numbers in flat arrays: nearly all have one transition (``word``, ``target``); only
    those with more keep a dictionary (``more``). A match is never held longer than ``window``
    words, so a state's suffix of that length is at most one link away.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.number, self.more = window, {}, {}
        self.word, self.target, self.link, self.length = (array("i", [x]) for x in (-1, 0, -1, 0))
        self.names = [name for name, _ in items]
        numbered = [array("i", [self.number.setdefault(w, len(self.number)) for w in words]) for _, words in items]
        for words in numbered:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.length)
        self.owner = array("i", [-1]) * n    # an item with the state's suffix of ``window`` words
        self.owners: dict[int, set] = {}     # all of them, where there are several
        self.whole: dict[int, dict] = {}     # length -> items of fewer words that end here
        for k, words in enumerate(numbered):
            v = size = 0
            for w in words:
                v, size = self._held(self._next(v, w), size + 1)
                if size == window:
                    self._own(v, k)
            if 0 < size < window:
                self.whole.setdefault(v, {}).setdefault(size, set()).add(k)
        # The nearest state on the way to the root, itself included, where a short item ends.
        self.short = array("i", [-1]) * n
        if self.whole:
            for v in sorted(range(1, n), key=self.length.__getitem__):
                self.short[v] = v if v in self.whole else self.short[self.link[v]]

    def _own(self, v: int, k: int) -> None:
        if self.owner[v] in (-1, k):
            self.owner[v] = k
        else:
            self.owners.setdefault(v, {self.owner[v]}).add(k)

    def _next(self, v: int, w: int) -> int:
        """The state after word w, or -1."""
        if self.word[v] == w:
            return self.target[v]
        return self.more[v].get(w, -1) if v in self.more else -1

    def _point(self, v: int, w: int, to: int) -> None:
        if self.word[v] in (-1, w):
            self.word[v], self.target[v] = w, to
        else:
            self.more.setdefault(v, {})[w] = to

    def _held(self, v: int, size: int) -> tuple[int, int]:
        """The state of the last ``window`` words of a match."""
        if size > self.window:
            size = self.window
            while self.length[self.link[v]] >= size:
                v = self.link[v]
        return v, size

    def _new(self, length: int, link: int) -> int:
        for a, x in ((self.word, -1), (self.target, 0), (self.link, link), (self.length, length)):
            a.append(x)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state for p's strings followed by w, divided from q where q also has longer ones."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._new(self.length[p] + 1, self.link[q])
        self.word[clone], self.target[clone] = self.word[q], self.target[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        while p != -1 and self._next(p, w) == q:
            self._point(p, w, clone)
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self._next(last, w)
        if q != -1:
            return self._split(last, q, w)
        cur, p = self._new(self.length[last] + 1, 0), last
        while p != -1 and self._next(p, w) == -1:
            self._point(p, w, cur)
            p = self.link[p]
        if p != -1:
            self.link[cur] = self._split(p, self._next(p, w), w)
        return cur

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (first word, word after the last) covered by windows, merged, and the items met."""
        number, link, length, window, short, whole = self.number, self.link, self.length, self.window, self.short, self.whole
        step, spans, met, v, size = self._next, [], set(), 0, 0
        for i, text in enumerate(words):
            w = number.get(text)
            if w is None:  # a word of no item ends every match
                v = size = 0
                continue
            t = step(v, w)
            while t == -1 and v:
                v = link[v]
                size = length[v]
                t = step(v, w)
            if t == -1:  # pragma: no cover - every word of an item leaves the root
                size = 0
                continue
            v, size = self._held(t, size + 1)
            longest = 0
            if size == window:
                longest = window
                met.update(self.owners.get(v) or (self.owner[v],))
            s = short[v]
            while s > 0:
                for m, ids in whole[s].items():
                    if m <= size:
                        longest = max(longest, m)
                        met |= ids
                s = short[link[s]]
            if longest:
                a, b = i + 1 - longest, i + 1
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, b))
        return spans, {self.names[k] for k in met}


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Blocks of (item id, words) of about ``block_bytes`` each: the size is counted first."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 1), F.lit(0))).first()[0]
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], folded(r["t"])) for r in part.toLocalIterator()]


def built(items: list[tuple[str, bytes]], window: int) -> Automaton:
    """The automaton of a block, made once per Python worker, which keeps the last one only."""
    kept = sys.__dict__.setdefault("_automaton_of_block", {})
    key = (window, hash(tuple(items)))
    if key not in kept:
        kept.clear()
        kept[key] = Automaton([(name, raw.split()) for name, raw in items], window)
    return kept[key]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 13, keep: list[str] | None = None,
                       block_bytes: int = 4 << 20) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` columns in ``keep`` plus, per row, the number of words, the hit words, the hit
    spans (byte offsets in the UTF-8 text, half open, with their words) and the sorted item ids.
    Returns the frame and the names the added columns got (underscored where ``keep`` clashes).

    Defined cases: NULL or empty texts and items have no words (no hit, no window); repeated
    rows and items count once per row; an empty benchmark hits nothing; a NULL item id reads
    ``null``; a text of any length streams word by word.
    """
    keep = list(docs.columns) if keep is None else keep
    names = {}
    for n in ("n_words", "n_hit", "spans", "items"):
        names[n] = free_name(keep + list(names.values()), n)
    text = free_name(keep + list(names.values()), "scanned")
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(text),
                       F.lit(0).cast("long").alias(names["n_words"]), F.lit(0).cast("long").alias(names["n_hit"]),
                       F.expr("cast(array() as array<struct<first:long,after:long,words:long>>)").alias(names["spans"]),
                       F.expr("cast(array() as array<string>)").alias(names["items"]))
    k = len(keep)
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("words", pa.int64())]))

    def step(items):
        def run(batches):
            automaton = built(items, window)
            for b in batches:
                n_words, n_hit, spans, met = [], [], [], []
                for t, old_spans, old_met in zip(b.column(k).to_pylist(), b.column(k + 3).to_pylist(), b.column(k + 4).to_pylist()):
                    raw = folded(t)
                    words = raw.split()
                    found, ids = automaton.scan(words)
                    if found:
                        at = [m.span() for m in WORD.finditer(raw)]
                        found = [{"first": at[i][0], "after": at[j - 1][1], "words": j - i} for i, j in found]
                    if old_spans:
                        found = merged(raw, old_spans + found)
                    n_words.append(len(words))
                    n_hit.append(sum(s["words"] for s in found))
                    spans.append(found)
                    met.append(sorted(ids.union(old_met)))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:k + 1], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(spans, span_type), pa.array(met, pa.list_(pa.string()))], b.schema.names)
        return run

    for at, items in enumerate(item_blocks(benchmark, item_id, item_text, block_bytes)):
        if at:
            kept = cut(kept, "decontamination-block")
        kept = kept.mapInArrow(step(items), kept.schema)
    return kept.drop(text), names


def merged(raw: bytes, spans: list[dict]) -> list[dict]:
    """Union of byte spans found by several blocks of items, words counted again."""
    out: list[list[int]] = []
    for s in sorted(spans, key=lambda s: s["first"]):
        if out and s["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["after"])
        else:
            out.append([s["first"], s["after"]])
    return [{"first": a, "after": b, "words": len(raw[a:b].split())} for a, b in out]


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                         item_text: str = "text", window: int = 13, coverage: int = 20,
                         max_span: int = 50) -> DataFrame:
    """``docs`` without what the benchmark has: a text of which one word in ``coverage`` or more is
    hit goes; from the others, spans of ``max_span`` words or more are cut out (a space
    takes their place). Texts without such spans come back unchanged, columns as they were."""
    found, n = find_contamination(docs, benchmark, text_col, item_id, item_text, window)
    hit, words, spans = F.col(n["n_hit"]), F.col(n["n_words"]), F.col(n["spans"])
    clean = found.where(~((hit > 0) & (coverage * hit >= words)))
    long = F.filter(spans, lambda s: s["words"] >= max_span)
    raw = F.col(f"`{text_col}`").cast("binary")
    # The pieces between long spans: from the end of one (or 0) to the start of the next (or the end).
    pieces = F.transform(F.sequence(F.lit(0), F.size(long)), lambda i: F.substring(
        raw, (F.when(i == 0, 0).otherwise(F.get(long, i - 1)["after"]) + 1).cast("int"),
        (F.coalesce(F.get(long, i)["first"], F.octet_length(raw)) - F.when(i == 0, 0).otherwise(F.get(long, i - 1)["after"])).cast("int"))
        .cast("string"))
    cut_text = F.when(F.size(long) > 0, F.array_join(pieces, " ")).otherwise(F.col(f"`{text_col}`"))
    return clean.withColumn(text_col, cut_text).select(*[F.col(f"`{c}`") for c in docs.columns])
