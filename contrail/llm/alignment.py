"""Cross-tokenizer alignment by interval coalescing.

A text's bytes (a space before it) are cut by a byte-level BPE (A) and by a sentencepiece model
(B). All A and B tokens of many texts are byte intervals on one line, the texts one after the
other. They are sorted by start; a running maximum of their ends runs over them, and a group
ends where a start reaches it: there A and B both have a boundary. Within the groups the pairs
of overlapping A and B tokens are the links.

How often an id pair is linked is a sum over the corpus. Tasks add up the pairs of many texts
(a block), Spark adds up the blocks by pair, and every block gets back the counts of its own
pairs, so no task ever holds the table of all pairs. A text keeps its distinct pairs as
positions in its block's list.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, field, free_name
from contrail.llm.packing import byte_of, encoder

#: A pair's key: A id above, B id below.
SHIFT = 32
LIST = "array<int>"


def vocabulary_bytes(path: str) -> list[bytes]:
    """The bytes of each id of the byte-level BPE file at ``path``."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    to_byte, out = byte_of(), {}
    for piece, i in d["model"]["vocab"].items():
        out[i] = bytes(to_byte[c] for c in piece) if all(c in to_byte for c in piece) else piece.encode()
    return [out.get(i, b"") for i in range(max(out) + 1)]


def piece_bytes(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: U+2581 is a space, <0xHH> a byte."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())]


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of two segmentations of the same bytes, as ends: (A index, B index) of every overlapping
    pair, and for each A and each B token its group's number."""
    na, nb = len(a_end), len(b_end)
    if not na:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    starts = np.concatenate([[0], a_end[:-1], [0], b_end[:-1]])
    ends = np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(na + nb), starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.concatenate([[False], starts[order][1:] >= reach[:-1]])
    group = np.empty(na + nb, np.int64)
    group[order] = np.cumsum(breaks)
    # Every B token expands over the A tokens it overlaps; they lie side by side.
    low = np.searchsorted(a_end, starts[na:], "right")
    n = np.searchsorted(starts[:na], b_end, "left") - low
    b = np.repeat(np.arange(nb), n)
    a = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return a, b, group[:na], group[na:]


class Aligner:
    """Both tokenizers of one worker process, and the words aligned so far.

    No token of either side reaches from a character that is not white space into the space after it (A's
    pattern; B's pieces have U+2581 at their start only, which is checked), so a text falls into
    words with their white space before them, and each different word is encoded once. New words are aligned
    many at a time.
    """

    _known: dict = {}

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.encode_a = encoder(a_path)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = vocabulary_bytes(a_path), piece_bytes(self.model)
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.apart = not any(" " in x.lstrip(b" ").decode(errors="replace") for x in self.b_bytes)
        self.clear()

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in cls._known:
            cls._known[a_path, b_path] = cls(a_path, b_path)
        return cls._known[a_path, b_path]

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.new: list[str] = []
        self.said: list[str] = []  # per word: its groups as text
        self.counts = np.zeros((0, 5), np.int64)  # per word: A tokens, B tokens, groups, links, whether its bytes are right
        self.keys = np.zeros(0, np.int64)  # the links' pairs, word after word

    def words(self, text: str) -> np.ndarray:
        """The numbers of a text's words (a space before the text)."""
        out, word = [], ""
        for part in text.split(" "):
            if word and not word[-1].isspace() and self.apart:
                out.append(word)
                word = " " + part
            else:
                word += " " + part
        out.append(word)
        number, new = self.number, self.new
        for w in out:
            if w not in number:
                number[w] = len(number)
                new.append(w)
        return np.array([number[w] for w in out], np.int64)

    def encoded(self, words: list[str]) -> tuple[list, list]:
        """Ids of every word by A and by B, none where either's bytes are not the word's."""
        a: list = [None] * len(words)
        solid = [k for k, w in enumerate(words) if not w[-1].isspace()]  # one after the other they are one text
        ids = self.encode_a("".join([words[k] for k in solid])).astype(np.int64)
        ends = np.cumsum([len(words[k].encode()) for k in solid])
        at = np.searchsorted(np.cumsum(self.a_size[ids]), ends, "left") + 1
        ids, lo = ids.tolist(), 0
        for k, hi in zip(solid, at.tolist()):
            a[k], lo = ids[lo:hi], hi
        for k, w in enumerate(words):
            if a[k] is None:
                a[k] = self.encode_a(w).tolist()
        b = self.model.encode([w[1:] for w in words], num_threads=1)
        for k, w in enumerate(words):
            if w.isspace() and w[-1] == " ":  # the model drops a space before nothing
                b[k] = self.model.encode("a" + w)[len(self.model.encode("a")):]
        want = "".join(words).encode()
        if any(b"".join([own[i] for ids in side for i in ids]) != want for own, side in ((self.a_bytes, a), (self.b_bytes, b))):
            for k, w in enumerate(words):
                if any(b"".join([own[i] for i in side[k]]) != w.encode() for own, side in ((self.a_bytes, a), (self.b_bytes, b))):
                    a[k], b[k] = [], []
        return a, b

    def learn(self, at_once: int = 1 << 15) -> None:
        """Align the new words, ``at_once`` at a time."""
        counts, keys = [self.counts], [self.keys]
        for k in range(0, len(self.new), at_once):
            c, own = self.line(self.new[k:k + at_once])
            counts.append(c)
            keys.append(own)
        self.counts, self.keys, self.new = np.concatenate(counts), np.concatenate(keys), []

    def line(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and pairs of the words, whose tokens lie one after the other on a line."""
        a_ids, b_ids = self.encoded(words)
        na, nb = (np.array([len(x) for x in side], np.int64) for side in (a_ids, b_ids))
        a, b = (np.array(list(chain.from_iterable(side)), np.int64) for side in (a_ids, b_ids))
        a_link, b_link, a_group, b_group = overlaps(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        # Both sides end where a word ends, so its groups are its own.
        word_at = np.concatenate([[0], np.cumsum(na)])
        starts = np.searchsorted(a_group, np.arange(a_group[-1] + 2 if len(a) else 1))
        group_at = np.searchsorted(starts[:-1], word_at)
        sides = []
        for ids, group in ((a, a_group), (b, b_group)):
            said, at = list(map(str, ids.tolist())), np.searchsorted(group, np.arange(len(starts))).tolist()
            sides.append([",".join(said[i:j]) for i, j in zip(at, at[1:])])
        groups = list(map("|".join, zip(*sides)))
        self.said += [";".join(groups[i:j]) for i, j in zip(group_at.tolist(), group_at[1:].tolist())]
        links = np.diff(np.searchsorted(b_link, np.concatenate([[0], np.cumsum(nb)])))
        return np.stack([na, nb, np.diff(group_at), links, na > 0], 1), a[a_link] << SHIFT | b[b_link]


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that start at ``first`` and have ``n`` numbers each, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def aligned(docs: DataFrame, a_path: str, b_path: str, text_col: str, keep: list[str], with_groups: bool, block_links: int,
            memory: int = 300_000) -> DataFrame:
    """A row per text (the columns in ``keep``, n_a, n_b, n_groups, n_links, groups, its distinct pairs as
    positions ``pair`` in its block's list and their numbers ``times``) and, with NULLs there, a row per block with the
    list: ``keys`` and ``sums``. Written once. A worker remembers about ``memory`` words."""
    def run(batches):
        known, part, number = Aligner.of(a_path, b_path), TaskContext.get().partitionId(), 0
        kept, texts, tokens = [], [], 0
        for batch in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
            kept.append(batch.select(list(range(len(keep)))))
            own = [known.words(t) if t else None for t in batch.column(len(keep)).to_pylist()]
            known.learn()
            texts += own
            tokens += sum(int(known.counts[w, :2].sum()) for w in own if w is not None)
            if tokens >= block_links or len(known.number) > memory:
                yield from block(known, kept, texts, part << 32 | number)
                kept, texts, tokens, number = [], [], 0, number + 1
                if len(known.number) > memory:
                    known.clear()
        if texts:
            yield from block(known, kept, texts, part << 32 | number)

    def block(known, kept, texts, number):
        counts, none = known.counts, np.zeros(0, np.int64)
        words = [w if w is not None and counts[w, 4].all() else none for w in texts]
        at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        every = np.concatenate(words)
        total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(counts[every, :4], 0)])
        total = total[at[1:]] - total[at[:-1]]
        first = np.concatenate([[0], np.cumsum(counts[:, 3])])
        used, often = np.unique(every, return_counts=True)
        own = ranges(first[used], counts[used, 3])
        keys, back = np.unique(known.keys[own], return_inverse=True)
        sums = np.bincount(back, np.repeat(often, counts[used, 3]), len(keys)).astype(np.int64)
        place = np.zeros(len(known.keys), np.int64)
        place[own] = back
        said, pairs, times = [], [], []
        for w in words:
            text = ";".join([known.said[k] for k in w.tolist()])
            said.append(text if with_groups or not text else hashlib.sha256(text.encode()).hexdigest())
            u, c = np.unique(w, return_counts=True)
            pair, turn = np.unique(place[ranges(first[u], counts[u, 3])], return_inverse=True)
            pairs.append(pair.astype(np.int32))
            times.append(np.bincount(turn, np.repeat(c, counts[u, 3]), len(pair)).astype(np.int32))
        table = pa.Table.from_batches(kept).combine_chunks()
        lists = lambda xs: pa.array(xs, pa.list_(pa.int32()))
        columns = [*(table.column(k).combine_chunks() for k in range(len(keep))), *(pa.array(total[:, k]) for k in range(4)),
                   pa.array(said, pa.string()), lists(pairs), lists(times), pa.array([number] * len(words), pa.int64())]
        names = [*keep, *NAMES]
        empty = [pa.nulls(len(words), pa.list_(pa.int64()))] * 2
        out = pa.RecordBatch.from_arrays([*columns, *empty], names)
        step = 4096
        yield from (out.slice(k, step) for k in range(0, len(words), step))
        if len(keys):
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, c.type) for c in columns[:-1]), pa.array([number], pa.int64()),
                                              pa.array([keys], pa.list_(pa.int64())), pa.array([sums], pa.list_(pa.int64()))], names)

    NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times", "block", "keys", "sums"]
    kept_types = ", ".join(field(docs, c, c) for c in keep)
    schema = (f"{kept_types}, n_a long, n_b long, n_groups long, n_links long, groups string, pair {LIST}, times {LIST}, block long, "
              "keys array<long>, sums array<long>")
    return cut(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema), "alignment")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False,
          block_links: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum; and the corpus-wide links
    (a, b, count, best). ``groups`` is the text of all groups (``with_groups``) or its SHA-256, '' without tokens.
    ``n_best`` counts the links whose pair has its B id's highest count, ``count_sum`` adds up the counts of all links.

    A block ends with the batch that brings its tokens to ``block_links``. Defined cases: a NULL or empty text, and one
    that either tokenizer changes, has no tokens and zeros; repeated rows count each; NULL ids stay;
    an empty table gives empty frames. Extra columns are not read.
    """
    rows = aligned(docs, a_path, b_path, text_col, [id_col], with_groups, block_links)
    lists = rows.where(F.col("keys").isNotNull()).select("block", F.posexplode(F.arrays_zip("keys", "sums")).alias("pair", "x"))
    found = lists.select("block", "pair", F.col("x.keys").alias("key"), F.col("x.sums").alias("n"))
    counts = cut(found.groupBy("key").agg(F.sum("n").alias("count")), "alignment-counts")
    b = F.col("key").bitwiseAND(F.lit((1 << SHIFT) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # at most one row per B id
    links = cut(counts.withColumn("b", b).join(highest, "b").select("key", F.shiftright("key", SHIFT).alias("a"), "b", "count",
                                                                    (F.col("count") == F.col("most")).alias("best")), "alignment-links")
    answers = found.join(links, "key").select(F.col("block").alias("of"), F.col("pair").alias("place"), "count", "best")
    out_names = [id_col, "n_a", "n_b", "n_groups", "n_links", "groups"]
    texts = rows.where(F.col("n_a").isNotNull()).select(*[F.col(f"`{c}`") for c in out_names], "pair", "times", "block")

    def joined(own: pa.Table, told: pa.Table) -> pa.Table:
        n = told.num_rows
        count, best = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        at = told.column("place").to_numpy()
        count[at], best[at] = told.column("count").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
        pairs, times = own.column("pair").combine_chunks(), own.column("times").combine_chunks()
        offsets = pairs.offsets.to_numpy()
        pair, time = pairs.values.to_numpy()[offsets[0]:offsets[-1]], times.values.to_numpy()[times.offsets[0].as_py():times.offsets[-1].as_py()].astype(np.int64)
        sums = []
        for x in (time * best[pair], time * count[pair]):
            whole = np.concatenate([[0], np.cumsum(x)])
            sums.append(whole[offsets[1:] - offsets[0]] - whole[offsets[:-1] - offsets[0]])
        out = own.select(out_names)
        return out.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))

    schema = f"{field(docs, id_col, id_col)}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    done = texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(joined, schema)
    return done.withColumnRenamed(id_col, free_name([c for c in done.columns if c != id_col], id_col)), links.select("a", "b", "count", "best")
