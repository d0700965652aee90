"""Mixing: targets against brute force, exact quotas, fair draws, slices that fit their documents."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from contrail.llm import mixing
from contrail.llm.common import table
from contrail.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE


def brute_targets(sizes: dict, pattern=(3, 1, 2), share=1.5, epochs=2) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: pattern[k % len(pattern)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole >= epochs * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in over:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def words(text):
    return re.findall(mixing.WORD, text or "")


def check(rows, slices, docs):
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len(words(t))
    target = brute_targets(size)
    assert sorted((str(r.doc_id), r.size, str(r.source)) for r in rows) == sorted((str(i), len(words(t)), str(s)) for i, t, s in docs)
    taken = Counter()
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 0.5
    per_shard = defaultdict(set)
    for r in slices:
        per_shard[r.shard].add(r.slot)
    assert all(got == set(range(len(got))) for got in per_shard.values())
    assert max(map(len, per_shard.values())) - min(map(len, per_shard.values())) <= 1
    assert sum(r.length for r in slices) == sum(taken.values())


def test_query_takes_its_targets(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text", "source").collect()]
    slices, rows = mixing.mix(table(spark, SF_SMALL, "documents"))
    rows = rows.collect()
    check(rows, slices.collect(), docs)
    again = QUERIES["op11_mixing"](spark, SF_SMALL).collect()  # reruns agree
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_slices_are_whole_passes_of_the_words(spark, docs):
    """Over all shards a document's slices cover each of its words as often as it is taken."""
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(n)), f"s{i % 3}") for i, n in enumerate((1, 7, 50, 300, 1500, 2, 4000, 9))]
    slices, rows = mixing.mix(docs(texts), shards=5, block_words=64)
    check(rows.collect(), slices.collect(), texts)
    taken = {r.doc_id: r.taken for r in rows.collect()}
    cover = defaultdict(Counter)
    joined = slices.join(docs(texts).select("doc_id", "text"), "doc_id").withColumn("said", mixing.slice_text(F.col("text"), F.col("start"), F.col("length")))
    for r in joined.collect():
        own = r.text.split()[r.start:r.start + r.length]
        assert r.said == " ".join(own) and len(own) == r.length
        cover[r.doc_id].update(range(r.start, r.start + r.length))
    for i, c in cover.items():
        assert sum(c.values()) == taken[i] and max(c.values()) <= 2 and max(c.values()) - min(c.get(k, 0) for k in range(len(texts[i][1].split()))) <= 1


def test_edge_rows(spark, docs):
    rows = [(1, "a b c", "s0"), (1, "a b c", "s0"), (2, None, None), (3, "", "s1"), (4, " \n", "s1"), (None, "x y z", None), (5, "w " * 5000, "s2")]
    slices, out = mixing.mix(docs(rows).withColumns({"size": F.lit("x"), "target": F.lit(1)}))
    check(out.collect(), slices.collect(), rows)
    slices, out = mixing.mix(docs(EDGE))
    check(out.collect(), slices.collect(), EDGE)
    assert mixing.mix(docs([]))[1].collect() == [] and mixing.mix(docs([(1, "", "s")]))[1].collect()[0].taken == 0


@pytest.mark.parametrize("sources,shards,quota", [(3, 4, 40), (5, 7, 1), (300, 3, 5)])
def test_tree_keeps_quotas_and_sizes(spark, sources, shards, quota):
    quotas = spark.range(sources).select(F.col("id").alias("rank"), (F.col("id") % 3 * quota + 1).alias("quota"))
    got = mixing.split_quotas(quotas, shards, seed=3).collect()
    per_source, per_shard = Counter(), Counter()
    for r in got:
        per_source[r.rank] += r.quota
        per_shard[r.shard] += r.quota
    assert dict(per_source) == {r.rank: r.quota for r in quotas.collect()}
    total = sum(per_source.values())
    assert all(n == total * (k + 1) // shards - total * k // shards for k, n in per_shard.items())


@pytest.mark.parametrize("total,good,n", [(10, 4, 5), (1000, 300, 100), (50, 50, 20), (9, 0, 3), (1 << 33, 1 << 31, 1 << 20)])
def test_draws_are_hypergeometric(spark, total, good, n):
    """Mean and variance over 4000 seeds, within five standard errors; always in the support."""
    c = lambda x: F.lit(x).cast("long")
    draws = [r[0] for r in spark.range(4000).select(mixing.hypergeometric(c(total), c(good), c(n), mixing.uniform(F.col("id")))).collect()]
    assert all(max(0, n + good - total) <= x <= min(n, good) for x in draws)
    p = good / total
    mean, var = n * p, n * p * (1 - p) * (total - n) / max(total - 1, 1)
    got = sum(draws) / len(draws)
    assert abs(got - mean) <= 5 * (var / len(draws)) ** 0.5 + 1e-9
    spread = sum((x - got) ** 2 for x in draws) / len(draws)
    assert abs(spread - var) <= 5 * var * (3 / len(draws)) ** 0.5 + 1e-9
