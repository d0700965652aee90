"""Cross-tokenizer alignment against a plain byte-by-byte version."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contrail.llm import alignment
from contrail.llm.common import table
from contrail.llm.packing import byte_of
from contrail.llm.queries import QUERIES, vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE

A, B = vocabulary_path(), vocabulary_path("piece_bpe_32k.model")


def brute_tokens(texts):
    """Per text its A and B tokens as (id, bytes), by the files' own libraries."""
    a, b, to_byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_of()
    a.encode_special_tokens = True
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    for t in texts:
        x, y = [], []
        if t:
            e = a.encode(" " + t, add_special_tokens=False)
            x = [(i, bytes(to_byte[c] for c in s)) for i, s in zip(e.ids, e.tokens)]
            y = [(i, piece(i)) for i in b.encode(t)]
            if any(b"".join(s for _, s in side) != (" " + t).encode() for side in (x, y)):
                x, y = [], []
        yield x, y


def brute(texts):
    rows, count = [], Counter()
    for x, y in brute_tokens(texts):
        ends = [np.cumsum([len(s) for _, s in side]).tolist() for side in (x, y)]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, at = [], [], [0, 0]
        for hi in both:
            ids = ["", ""]
            for k, side in enumerate((x, y)):
                stop = ends[k].index(hi, at[k]) + 1
                ids[k], at[k] = ",".join(str(i) for i, _ in side[at[k]:stop]), stop
            groups.append("|".join(ids))
        i = j = 0
        while i < len(x) and j < len(y):  # two fingers over the tokens
            links.append((x[i][0], y[j][0]))
            p, q = ends[0][i], ends[1][j]
            i, j = i + (p <= q), j + (q <= p)
        count.update(links)
        rows.append((len(x), len(y), ";".join(groups), len(groups), links))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(na, nb, n, len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), said)
            for na, nb, said, n, links in rows], count


def got(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows]


SAID = ["don't stop", "<|endoftext|> </s> <s> <unk>", "Ünï  cödé \U0001f600\n\n  x", " leading", "tab\tand\x00nul", "日本語 text", "a" * 500, "   ", "é" * 99, "﻿bom ﬁ", "x▁y"]


@pytest.mark.parametrize("block", [1, 50, 4_000_000])
def test_against_brute_force(spark, block):
    texts = SAID + [r.text for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(12).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, links = alignment.align(docs, A, B, with_groups=True, block_links=block)
    want, count = brute(texts)
    assert got(rows.orderBy("doc_id").collect()) == want
    assert {(r.a, r.b): r["count"] for r in links.collect()} == dict(count)


def test_whole_query(spark):
    docs = table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()
    want, _ = brute([r.text for r in docs])
    rows = QUERIES["op13_alignment"](spark, SF_SMALL).orderBy("doc_id").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    assert [tuple(r) for r in rows] == [(d.doc_id, *w[:6], sha(w[6])) for d, w in zip(docs, want)]
    assert sum(r.n_links for r in rows) > 100_000


def test_edge_rows(spark, docs):
    df = docs(EDGE).withColumns({"n_a": F.lit("x"), "block": F.lit(1), "pair": F.lit(2), "groups": F.lit(3)})
    rows, _ = alignment.align(df, A, B, with_groups=True)
    want, _ = brute([t for _, t, _ in EDGE])
    assert sorted(map(str, zip([r.doc_id for r in rows.collect()], got(rows.collect())))) == sorted(map(str, zip([i for i, _, _ in EDGE], want)))
    assert alignment.align(docs([]), A, B)[0].collect() == []
    long = ["é" * 30_000, " " * 30_000 + "x"]
    assert got(alignment.align(docs([(k, t, "s") for k, t in enumerate(long)]), A, B, with_groups=True)[0].orderBy("doc_id").collect()) == brute(long)[0]


def test_overlaps_of_random_cuts():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        ends = [np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n) for p in (0.4, 0.3)]
        a, b, ga, gb = alignment.overlaps(*ends)
        owner = [np.searchsorted(e, np.arange(n), "right") for e in ends]
        assert list(zip(a.tolist(), b.tolist())) == sorted(set(zip(owner[0].tolist(), owner[1].tolist())), key=lambda x: (x[1], x[0]))
        shared = sorted(set(ends[0]) & set(ends[1]))
        assert ga.tolist() == np.searchsorted(shared, ends[0]).tolist() and gb.tolist() == np.searchsorted(shared, ends[1]).tolist()
