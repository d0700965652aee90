"""Operators against second implementations, held-out rows and edge tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import digest, quality, toxicity
from contrail.llm.common import crc_fold, cut, table

SF = "/root/testdata/sf0.01"


def plain_digest(text):
    """The quartile bucket digest by plain loops."""
    raw = (text or "").encode()
    counts = [0] * 256
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        counts[((a * 65536 + b * 256 + c) * 2654435761) % 2 ** 32 // 2 ** 24] += 1
    ranked = sorted(counts)
    q = [ranked[63], ranked[127], ranked[191]]
    codes = [sum(n > x for x in q) for n in counts]
    head = [min(255, round(8 * math.log2(len(raw) + 1))), min(15, 16 * q[0] // (q[2] + 1)) * 16 + min(15, 16 * q[1] // (q[2] + 1))]
    packed = [codes[i] * 64 + codes[i + 1] * 16 + codes[i + 2] * 4 + codes[i + 3] for i in range(0, 256, 4)]
    return head, codes, "".join(f"{x:02x}" for x in head + packed)


def plain_likeness(x, y):
    (a, p, _), (b, q, _) = plain_digest(x), plain_digest(y)
    apart = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(i - j)] for i, j in zip(p, q)) + min(24, abs(a[0] - b[0]))
    apart += min(16, abs(a[1] // 16 - b[1] // 16) + abs(a[1] % 16 - b[1] % 16))
    return max(0.0, 1 - apart / ((256 * 6 + 24 + 16) / 4))


def test_digest_matches_a_plain_implementation(spark, docs):
    words = "lorem ipsum dolor sit amet é\U0001f600 consectetur".split()
    rows = [(i * 3, " ".join(words[(i * k) % len(words)] + str(k % (i + 1)) for k in range(i * 4)), "s") for i in range(30)] + [(200, None, None), (201, "ab", "s")]
    got = {r.doc_id: r for r in digest.edited_likeness(docs(rows)).collect()}
    assert len(got) == len(rows)
    for (i, t, _), (_, nxt, _) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited, r = t[:len(t) - half] + nxt[:half], got[i]
        assert (r.fingerprint, r.edited_fingerprint) == (plain_digest(t)[2], plain_digest(edited)[2])
        assert r.near_next == pytest.approx(plain_likeness(t, nxt)) and r.near_edited == pytest.approx(plain_likeness(t, edited))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_repeated_ids_go_by_text_and_keep_their_rows(docs):
    got = digest.edited_likeness(docs([(1, "b" * 50, "s"), (1, "a" * 50, "s"), (2, "c" * 50, "s")])).collect()
    want = {"a" * 25 + "b" * 25, "b" * 25 + "c" * 25, "c" * 25 + "a" * 25}
    assert {r.edited_sha256 for r in got} == {hashlib.sha256(t.encode()).hexdigest() for t in want}


def held_out(spark, out, column, label):
    labels = table(spark, SF, "labels").where(F.col(label).isNotNull())
    pairs = out.where(crc_fold("doc_id") == 0).join(labels, "doc_id").select(column, label).collect()
    assert len(pairs) > 30
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])


def test_quality_on_held_out_rows_only(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out, score = quality.scored(d, quality.train(d, labels))
    s, y = held_out(spark, out, score, "quality")
    assert np.mean((s >= 0.3) == (y == 1)) >= 0.95


def test_toxicity_on_held_out_rows_only(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out, n = toxicity.scored(d, toxicity.train(d, labels))
    s, y = held_out(spark, out, n["toxic_score"], "toxic")
    assert np.mean((s >= 0.5)[y == 0]) <= 0.03 and (not (y == 1).any() or s[y == 1].mean() > s[y == 0].mean() + 0.3)


@pytest.mark.parametrize("kind", ["empty", "nulls and clashing columns"])
def test_pipeline_on_edge_tables(spark, kind):
    d = table(spark, SF, "documents")
    if kind == "empty":
        d = d.limit(0)
    else:
        bare = d.where("doc_id < 40").unionByName(d.where("doc_id < 3").withColumn("doc_id", F.lit(None).cast("long")))
        bare = bare.unionByName(d.where("doc_id = 5").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in d.schema]))
        d = bare.withColumns({c: F.lit("x") for c in ("score", "spans", "base", "fingerprint", "component_id", "n_hit", "items", "terms", "label", "h")})
    columns = d.columns
    for name, stage in corpus_pipeline.STAGES:
        d = cut(stage(spark, d, SF), f"edge-{name}")
        assert name == "packing" or d.columns == columns
    assert d.count() == 0 if kind == "empty" else d.where("doc_id IS NOT NULL").count() > 0
