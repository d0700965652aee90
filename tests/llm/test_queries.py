"""Registered queries against their SQL, and the pipeline stage by stage."""

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from contrail.llm.common import cut, table
from contrail.llm.queries import ORACLE, QUERIES, vocabulary_path
from tests.conftest import SF_SMALL, rows
from tests.llm.test_operators import brute_base, brute_hits


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    want = [dict(zip([c[0] for c in cur.description], r)) for r in cur.fetchall()]
    got = QUERIES[name](spark, SF_SMALL)
    key = lambda r: tuple(str(r[c]) for c in sorted(got.columns))
    assert sorted(key(r.asDict()) for r in got.collect()) == sorted(map(key, want))


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF_SMALL, "documents")
    first, seen = docs.columns, []
    bench = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen.append((name, docs.count()))
        if name != "packing":
            assert docs.columns == first
        if name == "decontamination":
            for r in docs.collect():
                n, hit, _ = brute_hits(r.text, bench)
                assert not (hit and 20 * hit >= n)
        if name == "pii":
            ids = {r.doc_id for r in docs.collect()}
            assert not any(brute_base(r.text) for r in docs.collect())
    counts = [n for _, n in seen[:4]]
    assert counts == sorted(counts, reverse=True) and counts[0] < 200
    assert {r.doc_id for r in docs.collect()} == ids
    assert len(rows(docs)) >= len(ids)


def test_pipeline_ends_with_token_ids(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    docs = table(spark, SF_SMALL, "documents").limit(40)
    out = cut(dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF_SMALL), "test-ids")
    got = {}
    for r in out.collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    for r in docs.collect():
        want = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert b"".join(x for _, x in sorted(got[r.doc_id])) == want
