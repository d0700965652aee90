"""Phrase collocations from FM-indexes over word ids.

Every task turns its texts into shards: for one language a sequence of word ids with a separator
between pieces. A shard has a bidirectional FM-index: the Burrows-Wheeler transforms of the
sequence and of its reverse, sorted as deep as the phrases are long. A phrase is a pair of
intervals, one in each transform; extending it by a word on one side narrows both, and the
number of times each word stands there is the count of the longer phrase. Phrases are
enumerated to the depth limit, with counts and extensions, and the counts are summed across
shards by Spark.

A word that the whole language has fewer than ``least`` times cannot be part of a candidate, so
shards get the numbers of the frequent words (and only those of their own words) before they
extend anything; that leaves out no candidate. Phrases travel as word numbers, texts stay where
they are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import cut

#: Piece ends become one byte that no UTF-8 text has, a tab becomes a space, A-Z lower case.
MARK = b"\xff"
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", MARK * 10 + b" abcdefghijklmnopqrstuvwxyz")
BITS = 21  # of a word id in a sort key: three to a key
LIMIT = 3 << 18  # symbols of a shard: some 100 MB in a task


class WordIndex:
    """Bidirectional FM-index of a sequence of ids from 0 to ``size`` - 1, for phrases of up to ``depth`` ids.

    Suffixes are sorted by their first ``depth`` ids, so an interval of a phrase is right as long as the phrase is
    no longer. Intervals are arrays: ``low`` and ``back`` (first row in the transform of the sequence
    and of its reverse) and ``count``.
    """

    def __init__(self, ids: np.ndarray, size: int, depth: int = 3):
        self.n, self.size = len(ids), size
        ids = ids.astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=size))])
        self.forward, self.backward = self._transform(ids, depth), self._transform(ids[::-1], depth)
        self._ranks: dict[bool, np.ndarray] = {}

    def _transform(self, ids: np.ndarray, depth: int) -> np.ndarray:
        """For every suffix (of the cyclic sequence), sorted by ``depth`` ids, the id before it."""
        keys = [np.roll(ids, -k) for k in range(depth)]
        before = np.roll(ids, 1)
        if BITS * (depth + 1) <= 63 and self.size < 1 << BITS:  # the id before rides along in the key
            whole = keys[0]
            for k in (*keys[1:], before):
                whole = whole << BITS | k
            whole.sort()
            return (whole & (1 << BITS) - 1).astype(np.int32)
        return before[np.lexsort((before, *keys[::-1]))].astype(np.int32)

    def words(self, ids: np.ndarray) -> dict[str, np.ndarray]:
        """The intervals of single ids: the same rows in both transforms."""
        return {"low": self.first[ids], "back": self.first[ids], "count": self.first[ids + 1] - self.first[ids]}

    def rank(self, left: bool, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``row`` in a transform."""
        if left not in self._ranks:
            side = self.forward if left else self.backward
            keys = side.astype(np.int64) * (self.n + 1) + np.arange(self.n)
            keys.sort()
            self._ranks[left] = keys
        return np.searchsorted(self._ranks[left], symbol.astype(np.int64) * (self.n + 1) + row) - self.first[symbol]

    def extensions(self, at: dict[str, np.ndarray], left: bool, allowed: np.ndarray, both: bool = True) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Every phrase extended by every allowed id that stands at its left (or right): (the phrase's
        number, the id, the longer phrase's intervals). Without ``both`` only the interval of the other
        transform, the one to go on from at the other side."""
        side, rows, others = (self.forward, at["low"], at["back"]) if left else (self.backward, at["back"], at["low"])
        owner = np.repeat(np.arange(len(rows)), at["count"])
        first = np.cumsum(at["count"]) - at["count"]
        key = owner << 32 | side[np.arange(len(owner)) + np.repeat(rows - first, at["count"])]
        key.sort()
        start = np.flatnonzero(np.diff(key, prepend=-1))
        owner, symbol, count = key[start] >> 32, key[start] & 0xFFFFFFFF, np.diff(np.append(start, len(key)))
        # In the other transform the longer phrases follow each other by the new id.
        other = others[owner] + start - first[owner]
        keep = allowed[symbol]
        owner, symbol, count, other = (x[keep] for x in (owner, symbol, count, other))
        longer = {"back" if left else "low": other, "count": count}
        if both:
            longer["low" if left else "back"] = self.first[symbol] + self.rank(left, symbol, rows[owner])
        return owner, symbol, longer


def pieces_and_words(text: str) -> list[bytes]:
    """The words of a text, with ``MARK`` where a piece ends (and after the text)."""
    return (text.encode() + b"\n").translate(TABLE).replace(MARK, b" \xff ").split()


def stretches(words: list[bytes], symbols: int, depth: int = 3):
    """(sign, words) of a text in stretches of at most ``symbols``, cut where a piece ends. A longer piece is cut
    anywhere: the next stretch repeats the last ``depth`` - 1 words, and a stretch of sign -1 takes what
    that counts twice away again."""
    lo = 0
    while len(words) - lo > symbols:
        hi = lo + symbols
        end = next((k for k in range(hi - 1, lo - 1, -1) if words[k] == MARK), None)
        if end is not None:
            yield 1, words[lo:end + 1]
            lo = end + 1
        else:
            yield 1, [*words[lo:hi - 1], MARK]
            lo = hi - depth
            yield -1, [*words[lo:hi - 1], MARK]
    yield 1, words[lo:]


class Shard:
    """The words of one language so far."""

    def __init__(self):
        self.number: dict[bytes, int] = {MARK: 0}
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        number = self.number
        self.ids.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
        self.size += len(words)


def shards(docs: DataFrame, text_col: str, lang_col: str, symbols: int) -> DataFrame:
    """(shard, lang, sign, words, counts, ids, size): a row per shard, written once. ``words`` are its distinct words,
    ``ids`` its sequence (compressed): numbers into ``words`` from 1, 0 between pieces. ``sign`` as in ``stretches``."""
    def run(batches):
        part, made, open_ = TaskContext.get().partitionId(), 0, {}

        def closed(key):
            nonlocal made
            shard = open_.pop(key)
            ids = np.concatenate(shard.ids)
            counts = np.bincount(ids, minlength=len(shard.number))[1:]
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()),
                 pa.array([[w.decode() for w in list(shard.number)[1:]]], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([pa.compress(ids.tobytes(), codec="zstd", asbytes=True)], pa.binary()), pa.array([len(ids)], pa.int64())],
                ["shard", "lang", "sign", "words", "counts", "ids", "size"])

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for sign, words in stretches(pieces_and_words(text), symbols):
                    key = lang, sign
                    if key in open_ and open_[key].size + len(words) > symbols:
                        yield closed(key)
                    open_.setdefault(key, Shard()).add(words)
                if sum(s.size for s in open_.values()) > 2 * symbols:  # many languages: the largest goes first
                    yield closed(max(open_, key=lambda k: open_[k].size))
        for key in list(open_):
            yield closed(key)

    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    return cut(rows.mapInArrow(run, "shard long, lang string, sign long, words array<string>, counts array<long>, ids binary, size long"), "collocation-shards")


def phrases(shard: pa.Table, known: pa.Table) -> pa.Table:
    """Bigrams and trigrams of a shard's frequent words: (w1, w2, w3, n), w3 0 for a bigram, by word numbers."""
    size = shard.column("size")[0].as_py()
    ids = np.frombuffer(pa.decompress(shard.column("ids")[0].as_py(), decompressed_size=4 * size, codec="zstd", asbytes=True), np.int32)
    number = np.zeros(shard.column("distinct")[0].as_py() + 1, np.int64)
    number[known.column("id").to_numpy()] = known.column("number").to_numpy()
    index, frequent = WordIndex(ids, len(number)), number > 0
    words = np.flatnonzero(frequent)
    owner, second, pairs = index.extensions(index.words(words), False, frequent, both=False)
    first = words[owner]
    of, before, triples = index.extensions({**pairs, "back": np.zeros(len(owner), np.int64)}, True, frequent, both=False)
    columns = [np.concatenate(x) for x in ((number[first], number[before]), (number[second], number[first[of]]),
                                           (np.zeros(len(first), np.int64), number[second[of]]), (pairs["count"], triples["count"]))]
    columns[3] = columns[3] * shard.column("sign")[0].as_py()
    return pa.table(dict(zip(("w1", "w2", "w3", "n"), columns)))


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with numbers from 1 without gaps (small ones: they travel often), written once."""
    at = cut(words.withColumn("_at", F.monotonically_increasing_id()), "collocation-words")
    task = F.shiftright("_at", 33)  # the id is (task, place in the task)
    bases = at.groupBy(task.alias("_task")).count().select("_task", F.coalesce(F.sum("count").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return cut(at.withColumn("_task", task).join(bases, "_task")
               .withColumn("number", F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_task", "_base"), "collocation-numbers")


def scored(a: str, left: str, right: str):
    """floor(10^6 a^2 / (l r)), exact: products have up to 38 digits."""
    exact = lambda c: f"CAST({c} AS DECIMAL(16,0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * {exact(a)} * {exact(a)}) div ({exact(left)} * {exact(right)})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, inside: int = 50, symbols: int = LIMIT) -> DataFrame:
    """Every candidate that stays: lang, phrase, words, a, l, r, n, score.

    Candidates are the phrases of two and three words that a language has at least ``least`` times. ``score`` is the
    lowest floor(10^6 a^2 / (l r)) over the cuts into a first part of l and a rest of r occurrences (ties: the
    shortest first part), ``n`` the language's words. A bigram goes if a trigram around it has at least ``inside`` per cent of its count.
    ``symbols`` bounds a shard (words and piece ends).

    Defined cases: NULL and empty texts have no words; a NULL language is ``und``; repeated rows count each; a piece longer
    than a shard is counted exactly (see ``stretches``); an empty table gives no rows. Extra columns are not read.
    """
    rows = shards(docs, text_col, lang_col, min(symbols, LIMIT))
    found = rows.select("shard", "lang", "sign", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")).select(
        "shard", "lang", F.col("x.words").alias("word"), (F.col("at") + 1).alias("id"), (F.col("sign") * F.col("x.counts")).alias("n"))
    words = found.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = numbered(words)
    totals = rows.groupBy("lang").agg(F.sum(F.col("sign") * F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))

    own = rows.select("shard", "sign", "ids", "size", F.size("words").cast("long").alias("distinct"))
    known = found.join(words, ["lang", "word"]).select(F.col("shard").alias("of"), F.col("id").cast("long").alias("id"), "number")
    counted = own.groupBy("shard").cogroup(known.groupBy("of")).applyInArrow(phrases, "w1 long, w2 long, w3 long, n long")
    sums = cut(counted.groupBy("w1", "w2", "w3").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "collocation-phrases")

    def word(k: int) -> DataFrame:
        return words.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("f").alias(f"f{k}"), *(["lang"] if k == 1 else []))

    pairs, triples = sums.where("w3 = 0").drop("w3"), sums.where("w3 > 0")
    longest = (triples.select(F.expr("stack(2, w1, w2, w2, w3)").alias("w1", "w2"), "a").groupBy("w1", "w2").agg(F.max("a").alias("longer")))
    two = (pairs.join(longest, ["w1", "w2"], "left").where(100 * F.coalesce("longer", F.lit(0)) < inside * F.col("a"))
           .join(word(1), "w1").join(word(2), "w2")
           .select("lang", F.array("t1", "t2").alias("words"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), scored("a", "f1", "f2").alias("score")))
    part = lambda x, y, f: pairs.select(F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(f))
    three = (triples.join(part("w2", "w3", "f23"), ["w2", "w3"]).join(part("w1", "w2", "f12"), ["w1", "w2"])
             .join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
             .withColumns({"s1": scored("a", "f1", "f23"), "s2": scored("a", "f12", "f3")}).withColumn("early", F.col("s1") <= F.col("s2"))
             .select("lang", F.array("t1", "t2", "t3").alias("words"), "a", F.when(F.col("early"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
                     F.when(F.col("early"), F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score")))
    return two.unionByName(three).join(totals, "lang").select("lang", F.array_join("words", " ").alias("phrase"), "words", "a", "l", "r", "n", "score")


def ranked(candidates: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` by score, then a (both descending), then phrase, with ``rank`` from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))
