"""The model's scores against counts and formulas of their own, counts over 2^32, ids of other types."""

import random
import zlib
from collections import Counter
from math import floor, log2, log10

import numpy as np
import pyarrow as pa
import pytest

from contrail.llm import language_model as lm


def corpus():
    rnd = random.Random(14)
    rows = [(i, " ".join(rnd.choice(["The", "cat", "sat", "on", "é", "mat.", f"w{rnd.randint(0, 40)}"]) for _ in range(rnd.randint(0, 30))), "s") for i in range(150)]
    return [*rows, (500, None, None), (501, "never seen words", None)]


def test_score_matches_brute_force_counts_and_the_learned_weights(spark, docs, monkeypatch):
    learned = {}

    def learn(cells, *args, original=lm.learn):
        learned.update(original(cells, *args))
        return dict(learned)

    monkeypatch.setattr(lm, "learn", learn)
    rows = corpus()
    out = {r.doc_id: r.score for r in lm.scores(docs(rows), block_tokens=150, shard_bytes=400).collect()}
    words = {i: (t or "").encode().lower().split() + [b"\n"] for i, t, _ in rows}
    train = [ws for i, ws in words.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    one = Counter(w for ws in train for w in ws)
    two = Counter(p for ws in train for p in zip([b"\n", *ws], ws))
    n, v = sum(one.values()), len(one)
    for i, ws in words.items():
        total = 0.0
        for c, w in zip([b"\n", *ws], ws):
            bucket = 1 + floor(log2(one[c])) if one[c] else 0
            b = max((k for k in learned if k <= bucket), default=min(learned))
            x = learned[b] if one[c] else learned.get(0, np.array([0, .5, .5]))
            total += log10(x[0] * two[c, w] / max(one[c], 1) + x[1] * one[w] / n + x[2] / (v + 1))
        assert out[i] == pytest.approx(total)


def test_counts_over_32_bits():
    rnd = np.random.default_rng(1)
    small, large = rnd.integers(0, 1 << 32, 1000), rnd.integers(0, 1 << 62, 1000)
    assert (lm.uncounted(lm.counted(small)) == small).all() and (lm.uncounted(lm.counted(large)) == large).all()
    assert lm.uncounted(lm.counted(np.array([(1 << 32) + 5]))).tolist() == [(1 << 32) + 5] and len(lm.uncounted(lm.counted(small[:0]))) == 0
    # One block whose answers hold such counts: they reach the block's own row unchanged.
    block = lm.Block(pa.int64())
    block.add((7, 1), "a b a")
    rows = list(block.requests(0, 1))
    table = lm.answer(None, pa.Table.from_batches([lm.batch(rows)])).to_pylist()
    for r in table:
        if r["kind"] in "wp":
            r["a"] = lm.counted(lm.uncounted(r["a"]).astype(np.int64) + (1 << 33))
    back = lm.gather(None, pa.Table.from_batches([lm.batch([tuple(r[f.name] for f in lm.ARROW) for r in table if r["kind"] != "s"])])).to_pylist()
    _, six, d = lm.opened(back[0])
    assert d.column("id").to_pylist() == [7] and sorted((six[2] - (1 << 33)).astype(int).tolist()) == [1, 1, 2, 2]


def test_text_ids(spark, docs):
    named = docs([(i, t, s) for i, t, s in corpus()]).selectExpr("concat('doc-', doc_id) AS doc_id", "text")
    out = lm.scores(named, block_tokens=150, shard_bytes=400)
    assert out.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(r.doc_id for r in out.collect()) == sorted(f"doc-{i}" for i, _, _ in corpus())
