"""Collocations: the FM-index against plain counting, the operator against brute force and SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import collocations as C
from tests.llm.conftest import EDGE


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, least=10, inside=50):
    """docs: (text, lang) -> {(lang, phrase): (a, l, r, n, score)} of the candidates that stay."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for p in pieces(text):
            n[lang] += len(p)
            for k in (1, 2, 3):
                f[lang].update(tuple(p[i:i + k]) for i in range(len(p) - k + 1))
    out = {}
    for lang, c in f.items():
        cands = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        for g, a in cands.items():
            if len(g) == 2 and any(len(t) == 3 and g in (t[:2], t[1:]) and 100 * b >= inside * a for t, b in cands.items()):
                continue
            score, k = min((10**6 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            out[lang, " ".join(g)] = (a, c[g[:k]], c[g[k:]], n[lang], score)
    return out


def found(df):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_index_counts_and_extensions(depth):
    rng = np.random.default_rng(depth)
    ids = np.append(rng.integers(0, 6, 400), 0).astype(np.int32)
    index, every = C.WordIndex(ids, 6, depth), np.array([False] + [True] * 5)
    whole = ids.tolist()
    count = lambda p: sum(tuple(whole[i:i + len(p)]) == p for i in range(len(whole) - len(p) + 1))
    phrases, at = [(w,) for w in range(1, 6)], index.words(np.arange(1, 6))
    for k in range(1, depth):  # left and right in turns, intervals of both transforms kept
        left = k % 2 == 1
        owner, symbol, at = index.extensions(at, left, every)
        phrases = [(s, *phrases[o]) if left else (*phrases[o], s) for o, s in zip(owner.tolist(), symbol.tolist())]
        assert len(set(phrases)) == len(phrases) and at["count"].tolist() == [count(p) for p in phrases]
        assert sum(at["count"]) == sum(0 not in whole[i:i + k + 1] for i in range(len(whole) - k))


def texts(n, seed, words=12):
    rng = np.random.default_rng(seed)
    vocabulary = ["New", "york", "City", "the", "of", "ünï", "a-b", "x\x00y", "it's", "7", "zz", "q"][:words]
    return ["".join(vocabulary[rng.integers(words)] + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ","]) for _ in range(rng.integers(1, 120))) for _ in range(n)]


def test_against_brute_force(spark):
    rows = [(t, lang) for k, lang in enumerate(("en", "de", None)) for t in texts(40, k)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert found(C.collocations(docs)) == brute(rows)
    assert found(C.collocations(docs, least=3, inside=80, symbols=200)) == brute(rows, 3, 80)


def test_pieces_longer_than_a_shard(spark):
    """Cuts inside a piece neither lose nor repeat a phrase."""
    rows = [(" ".join(np.random.default_rng(5).choice(["a", "b", "c", "d"], 500)), "en"), ("a b, " * 30, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert found(C.collocations(docs, symbols=40)) == brute(rows)


def test_edge_rows(spark, docs):
    df = docs(EDGE).withColumns({"word": F.lit("x"), "n": F.lit(1), "rank": F.lit(2)})
    assert found(C.collocations(df, least=2)) == brute([(t, "en") for _, t, _ in EDGE], 2)
    assert C.collocations(docs([])).collect() == []
    shared = "one two three. " * 400  # one phrase in a third of all rows
    rows = [(shared, "en")] * 20 + [(t, "en") for t in texts(40, 9, 6)]
    assert found(C.collocations(spark.createDataFrame(rows, "text string, lang string"))) == brute(rows)


def test_ranks_and_exact_products(spark):
    rows = spark.createDataFrame([("en", "b", 5, 9), ("en", "a", 5, 9), ("en", "z", 6, 9), ("en", "ü", 1, 99), ("de", "q", 1, 1)], "lang string, phrase string, a long, score long")
    assert sorted((r.lang, r["rank"], r.phrase) for r in C.ranked(rows, 3).collect()) == [("de", 1, "q"), ("en", 1, "ü"), ("en", 2, "z"), ("en", 3, "a")]
    big = [(10**13 + 7, 10**13 + 9, 10**14 + 3), (10**15, 10**15, 10**15), (10, 10, 10), (999999999999, 10**12 + 1, 10**15 - 1)]
    got = spark.createDataFrame(big, "a long, l long, r long").select(C.scored("a", "l", "r")).collect()
    assert [r[0] for r in got] == [10**6 * a * a // (x * y) for a, x, y in big]
