"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < 2 < 3 are ordered; P(grade > j) = sigmoid(w . x - theta_j) with one weight
vector for all thresholds (proportional odds). x holds, for each feature word, a damped count.
The expected severity is the sum of P(grade > j).

The labels only tell toxic from not. Severity grades of the training rows are made from them:
grade 0 is not toxic; toxic rows are graded by how often the words that mark toxic rows occur
in them (``grade_of``). So the first threshold is learned from the labels themselves, the
others order the toxic rows by the number of such words.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import crc_fold, cut, free_name
from contrail.llm.decontaminate import folded

GRADES = 3  # thresholds: grades 0 to 3


PART = 200_000  # features counted together before a task hands them on
PREFIXES = (4, 5, 6, 7)  # characters; inflected and compounded forms share them


def features_of(text: str | None) -> dict[str, int]:
    """Counts of the text's words (``w:``) and of the prefixes of longer ones (``p:``)."""
    out: dict[str, int] = {}
    for w, n in Counter(folded(text).decode("utf-8", "replace").split()).items():
        out["w:" + w] = n
        for k in PREFIXES:
            if len(w) > k:
                p = "p:" + w[:k]
                out[p] = out.get(p, 0) + n
    return out


def counts_of(text: str | None, vocabulary: dict[str, int]) -> dict[int, int]:
    """``features_of`` restricted to a vocabulary, by number."""
    out: dict[int, int] = {}
    get = vocabulary.get
    for w, n in Counter(folded(text).decode("utf-8", "replace").split()).items():
        k = get("w:" + w)
        if k is not None:
            out[k] = out.get(k, 0) + n
        for size in PREFIXES:
            if len(w) <= size:
                break
            k = get("p:" + w[:size])
            if k is not None:
                out[k] = out.get(k, 0) + n
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: dict
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) per text and threshold."""
        z = np.array([sum(self.weights[k] * np.log1p(n) for k, n in counts_of(t, self.vocabulary).items()) for t in texts], np.float64)
        return sigmoid(z[:, None] - self.thresholds[None, :])


def fit_ordinal(rows: list[dict[int, float]], grades: np.ndarray, size: int, ridge: float = 3e-5, steps: int = 1000, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model by Adam; thresholds stay ordered since they
    are the first one plus positive steps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([k for r in rows for k in r], np.int64)
    val = np.array([v for r in rows for v in r.values()], np.float64)
    x = np.zeros(size + GRADES)
    shares = [(np.sum(grades > j) + 0.5) / (len(grades) + 1) for j in range(GRADES)]
    start = np.log((1 - np.array(shares)) / shares)
    x[size] = start[0]
    x[size + 1:] = np.log(np.maximum(np.diff(start), 1e-2))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, gaps = x[:size], np.exp(x[size + 1:])
        theta = x[size] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(at, weights=w[col] * val, minlength=len(rows))
        # P(grade <= j) with the ends 0 and 1; d/dz of log(P(<= y) - P(<= y - 1)).
        upto = np.column_stack([np.zeros(len(rows)), sigmoid(theta[None, :] - z[:, None]), np.ones(len(rows))])
        slope = upto * (1 - upto)
        rows_at = np.arange(len(rows))
        p = np.maximum(upto[rows_at, grades + 1] - upto[rows_at, grades], 1e-12)
        hi, lo = slope[rows_at, grades + 1] / p, slope[rows_at, grades] / p
        gz = hi - lo  # minus d log p / dz
        gt = np.array([np.sum(lo[grades == j + 1]) - np.sum(hi[grades == j]) for j in range(GRADES)])
        g = np.concatenate([np.bincount(col, weights=gz[at] * val, minlength=size) / len(rows) + ridge * w,
                            [gt.sum() / len(rows)], [gt[j:].sum() / len(rows) * gaps[j - 1] for j in range(1, GRADES)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:size], x[size] + np.concatenate([[0], np.cumsum(np.exp(x[size + 1:]))])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 5, held_out_fold: int = 0, max_rows: int = 20_000, features: int = 2048, min_docs: int = 3,
          min_g: float = 12.0) -> OrdinalModel:
    """Learn from at most ``max_rows`` labelled rows outside the held-out fold (lowest id hashes: a
    uniform sample). The ``features`` words and prefixes whose presence tells most about the label (G test,
    ``min_g`` or more, in at least ``min_docs`` rows) are counted in Spark, each task adding up its own rows
    first; the driver sees only the chosen features' counts, one row per sampled row."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_fold(id_col, folds) != held_out_fold))
              .groupBy(F.col(id_col).alias("lid")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("lid"), "lid").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("did"), F.col(text_col).alias("t"))
    rows = texts.join(F.broadcast(chosen), F.col("did") == F.col("lid")).select(F.xxhash64("lid", "t").alias("row"), "label", "t")

    def words(batches):
        def part(seen, marked):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()),
                                               pa.array([marked[w] for w in seen], pa.int64())], ["word", "docs", "toxic_docs"])

        for b in batches:
            seen, marked = Counter(), Counter()
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = features_of(text).keys()
                seen.update(found)
                if label:
                    marked.update(found)
                if len(seen) > PART:
                    yield part(seen, marked)
                    seen, marked = Counter(), Counter()
            yield part(seen, marked)

    sample = cut(rows.dropDuplicates(["row"]), "toxicity-sample")
    seen = sample.select("label", "t").mapInArrow(words, "word string, docs long, toxic_docs long")
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if toxic in (0, total):
        return OrdinalModel({}, np.zeros(0), np.array([1.0, 2.0, 3.0]) * (1 if not toxic else -1))
    # G statistic of presence against label; only words more common in toxic rows can mark them.
    n, k = F.col("docs").cast("double"), F.col("toxic_docs").cast("double")
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    rate = float(toxic) / float(total)
    g = part(k, n * rate) + part(n - k, n * (1 - rate)) + part(toxic - k, (total - n) * rate) + part(total - toxic - n + k, (total - n) * (1 - rate))
    best = (seen.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("toxic_docs").alias("toxic_docs")).where(F.col("docs") >= min_docs)
            .select("word", g.alias("g"), (k / n > rate).alias("marks"), (F.sqrt(k / n)).alias("purity")).where(F.col("g") >= min_g).orderBy(F.desc("g"), "word").limit(features))
    words_list = best.collect()
    vocabulary = {r["word"]: i for i, r in enumerate(words_list)}
    marks = {i for i, r in enumerate(words_list) if r["marks"] and r["g"] > 15 and r["purity"] > 0.7}

    def counted(batches):
        for b in batches:
            found = [counts_of(t, vocabulary) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                                              pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))], ["row", "label", "features", "counts"])

    learned = sample.select("row", "label", "t").mapInArrow(counted, "row long, label int, features array<int>, counts array<long>").collect()
    learned.sort(key=lambda r: r["row"])
    marked = np.array([sum(n for w, n in zip(r["features"], r["counts"]) if w in marks) for r in learned])
    grades = grade_of(marked, np.array([r["label"] == 1 for r in learned]))
    x = [dict(zip(r["features"], np.log1p(r["counts"]).tolist())) for r in learned]
    weights, thresholds = fit_ordinal(x, grades, len(vocabulary))
    return OrdinalModel(vocabulary, weights, thresholds)


def grade_of(marked: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for rows that are not toxic, else 1 to 3 by tertiles of the marking words among toxic rows."""
    cuts = np.quantile(marked[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    return np.where(toxic, 1 + (marked > cuts[0]) + (marked > cuts[1]), 0).astype(np.int64)


def scored(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` columns, ``severity`` (expected grade, 0 to 3) and ``toxic_score`` = P(grade > 0).

    Defined cases: NULL and empty texts have no features (the prior's severity); repeated rows
    get equal scores; very long texts are counted word by word; no shuffle.
    """
    keep = list(docs.columns) if keep is None else keep
    names = {}
    for c in ("severity", "toxic_score"):
        names[c] = free_name([*keep, *names.values()], c)
    k = len(keep)
    text = free_name([*keep, *names.values()], "read")

    def run(batches):
        for b in batches:
            above = model.above(b.column(k).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(above.sum(axis=1)), pa.array(above[:, 0])], [*b.schema.names[:k], *names.values()])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(text))
    schema = rows.select(*[F.col(f"`{c}`") for c in keep], *[F.lit(0.0).alias(n) for n in names.values()]).schema
    return rows.mapInArrow(run, schema), names
