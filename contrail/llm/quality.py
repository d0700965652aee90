"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are made in one pass. Shallow boosted trees are grown on labelled
rows; every path from a root to a node is a rule, a conjunction of comparisons. A lasso
logistic regression over the rules (and the statistics) keeps a few, and these are compiled
into one Spark column expression, so scoring is a projection on the statistics.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import crc_fold, cut, free_name

STATS = ("log_chars", "log_words", "word_length", "upper", "digit", "punctuation", "symbol", "space", "non_ascii", "words_per_line",
         "repeated_lines", "distinct_words", "top_word", "entropy", "words_ending_odd", "capital_words", "longest_word")
#: Byte classes of the statistics (fixed values).
CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "space": (32, *range(9, 14)), "non_ascii": range(128, 256),
           "punctuation": b".,;:!?'\"()-", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~"}
CLASS_OF = np.array([[b in members for b in range(256)] for members in CLASSES.values()], np.float64).T
ODD_ENDS = tuple(bytes([c]) for c in b"!#$%&*|{}<>=_~^")


def statistics(text: str | None) -> list[float]:
    """The statistics of a text; all are 0 where there is nothing to count."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = dict(zip(CLASSES, hist @ CLASS_OF / n))
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    many = max(1, len(words))
    counts = Counter(words)
    p = hist[hist > 0] / n
    value = {
        "log_chars": float(np.log1p(len(raw))), "log_words": float(np.log1p(len(words))), "word_length": sum(map(len, words)) / many,
        "words_per_line": len(words) / max(1, len(lines)), "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        "distinct_words": len(counts) / many, "top_word": max(counts.values(), default=0) / many,
        "entropy": float(-(p * np.log2(p)).sum()) if len(p) else 0.0,
        "words_ending_odd": sum(n for w, n in counts.items() if w.endswith(ODD_ENDS)) / many,
        "capital_words": sum(n for w, n in counts.items() if len(w) > 1 and w.isupper()) / many,
        "longest_word": float(np.log1p(max(map(len, counts), default=0))), **share}
    return [float(value[s]) for s in STATS]


def with_statistics(docs: DataFrame, text_col: str, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The ``keep`` columns and one double per statistic; returns their (free) names too."""
    names = []
    for s in STATS:
        names.append(free_name([*keep, *names], f"stat_{s}"))
    text = free_name([*keep, *names], "measured")
    k = len(keep)

    def run(batches):
        for b in batches:
            m = np.array([statistics(t) for t in b.column(k).to_pylist()], np.float64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *(pa.array(m[:, j]) for j in range(len(STATS)))], [*b.schema.names[:k], *names])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(text))
    schema = rows.select(*[F.col(f"`{c}`") for c in keep], *[F.lit(0.0).alias(n) for n in names]).schema
    return rows.mapInArrow(run, schema), names


@dataclass(frozen=True)
class Rule:
    """Statistic index, whether at most (else above), bound; all must hold."""
    terms: tuple[tuple[int, bool, float], ...]

    def column(self, names: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(names[i]) <= v if low else F.col(names[i]) > v for i, low, v in self.terms])


def paths(tree) -> list[Rule]:
    """A rule for every node but the root."""
    found = []

    def walk(node, terms):
        if terms:
            found.append(Rule(tuple(sorted(terms))))
        if node.numDescendants() > 0:
            split = node.split()
            i, v = split.featureIndex(), split.threshold()
            walk(node.leftChild(), [*terms, (i, True, v)])
            walk(node.rightChild(), [*terms, (i, False, v)])

    walk(tree._call_java("rootNode"), [])
    return found


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Rule, float], ...]
    linear: tuple[float, ...]
    intercept: float

    def score(self, names: list[str]) -> Column:
        total = F.lit(self.intercept)
        for rule, w in self.rules:
            total = total + F.when(rule.column(names), F.lit(w)).otherwise(0.0)
        for name, w in zip(names, self.linear):
            if w:
                total = total + F.col(name) * w
        return 1 / (1 + F.exp(-total))


def fit(rows: DataFrame, names: list[str], label: str, trees: int = 12, depth: int = 3, penalty: float = 5e-4) -> RuleModel:
    """Rules from boosted trees on ``rows`` (statistics and a 0/1 label), lasso weights for them.
    One label or no rows: no rules, the (smoothed) share of label 1 as a constant."""
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if ones in (0, n):
        return RuleModel((), (0.0,) * len(names), float(np.log((ones + 1) / (n - ones + 1))))
    data = rows.select(F.col(label).cast("double").alias("label"), *names, array_to_vector(F.array(*names)).alias("features"))
    grown = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=max(1, n // 500), seed=1).fit(data)
    rules = list(dict.fromkeys(r for t in grown.trees for r in paths(t)))
    inputs = [r.column(names).cast("double") for r in rules] + [F.col(x) for x in names]
    design = data.select("label", array_to_vector(F.array(*inputs)).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True).fit(design)
    w = lasso.coefficients.toArray().tolist()
    return RuleModel(tuple((r, x) for r, x in zip(rules, w) if x), tuple(w[len(rules):]), float(lasso.intercept))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 5, held_out_fold: int = 0, max_rows: int = 20_000) -> RuleModel:
    """Learn from the labelled rows outside the held-out fold: at most ``max_rows`` of them, those
    whose ids hash lowest (a uniform sample). Rows without a label, id or text teach nothing."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_fold(id_col, folds) != held_out_fold))
              .groupBy(F.col(id_col).alias("lid")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("lid"), "lid").limit(max_rows))
    # Bounded by max_rows (two numbers each), so it is broadcast and texts do not move.
    texts = docs.select(F.col(id_col).alias("did"), F.col(text_col).alias("t")).where("did is not null and t is not null")
    rows = texts.join(F.broadcast(chosen), F.col("did") == F.col("lid")).select("label", "t")
    measured, names = with_statistics(rows, "t", ["label"])
    # At most ``max_rows`` short rows: two tasks read them, however many tasks wrote them.
    return fit(cut(measured, "quality-sample").coalesce(2), names, "label")


def scored(docs: DataFrame, model: RuleModel, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``keep`` columns (default: all) and a score in (0, 1); returns the score's (free) name.

    Defined cases: NULL and empty texts have zero statistics and a score like any other;
    repeated rows get equal scores; an empty table gives an empty result; no shuffle.
    """
    keep = list(docs.columns) if keep is None else keep
    measured, names = with_statistics(docs, text_col, keep)
    score = free_name(keep, "score")
    return measured.select(*[F.col(f"`{c}`") for c in keep], model.score(names).alias(score)), score
