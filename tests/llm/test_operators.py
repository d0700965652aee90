"""Operators against brute force on small fixtures, with every defined edge case."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from contrail.llm import chat, decontaminate, digest, language_model, packing, pii, quality, sharding, simhash, toxicity
from contrail.llm.common import table
from contrail.llm.graph import components
from contrail.llm.queries import QUERIES, vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE


def brute_simhash(text, k=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, links):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if links(fps[i], fps[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("max_bucket", [1, 64])  # 1: every shared bucket takes the way of large ones
def test_simhash_links_are_exact(spark, max_bucket):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains of near copies, 0 to 3 bits apart
        x = rnd.choice(fps)
        for b in rnd.sample(range(64), rnd.randint(0, 3)):
            x ^= 1 << b
        fps.append(x)
    fps = list(dict.fromkeys(fps))
    nodes = spark.createDataFrame([(simhash._signed(x), i) for i, x in enumerate(fps)], "fp long, node long")
    got = dict((r.node, r.root) for r in components(simhash.links(nodes, 2, max_bucket)).collect())
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    assert [got.get(i, i) for i in range(len(fps))] == want


def test_near_duplicates_edges_and_fingerprints(spark, docs):
    got = simhash.near_duplicates(docs(EDGE).withColumn("component_id", F.lit("clash"))).collect()
    assert len(got) == len(EDGE)
    for r in got:
        if r.doc_id is not None:
            text = next(t for i, t, _ in EDGE if i == r.doc_id)
            assert r.fingerprint == f"{brute_simhash(text):016x}"
    comp = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert comp[6] == comp[1] == 1 and comp[3] == comp[4] == comp[2] == 2
    assert simhash.near_duplicates(docs([])).count() == 0
    kept = simhash.one_of_each(docs(EDGE))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 5]
    # Rows without an id, and an id that two texts share, lose no text.
    nameless = [(None, "one two three four", "s"), (None, "five six seven eight", "s"), (None, "five six seven eight", "s"),
                (9, "alpha beta gamma delta", "s"), (9, "red green blue white", "s")]
    assert sorted(r.text for r in simhash.one_of_each(docs(nameless)).collect()) == sorted({t for _, t, _ in nameless})


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def brute_hits(text, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, met = words(text), set(), set()
    for name, t in items:
        v = words(t)
        m = min(window, len(v))
        for s in {tuple(v[i:i + m]) for i in range(len(v) - m + 1)} if v else ():
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) == s:
                    hit.update(range(i, i + m))
                    met.add(name)
    return len(w), len(hit), sorted(met)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_decontamination_matches_brute_force(spark, docs, block_bytes):
    rnd = random.Random(1)
    word = lambda: rnd.choice(["aa", "b", "é", "C", "d9"])
    items = [(f"{k}", " ".join(word() for _ in range(rnd.choice([0, 1, 3, 6, 9])))) for k in range(12)] + [("10", None), ("2", "aa b aa b")]
    rows = [(i, " ".join(word() for _ in range(rnd.randint(0, 40))).replace(" ", ", ", 1), "s") for i in range(60)] + [(None, None, None), (99, "", "s")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    found, n = decontaminate.find_contamination(docs(rows).withColumn("spans", F.lit(1)), bench, window=5, block_bytes=block_bytes)
    assert n["spans"] == "_spans" and found.count() == len(rows)
    got = {r.doc_id: (r[n["n_words"]], r[n["n_hit"]], r[n["items"]]) for r in found.collect()}
    assert got == {i: brute_hits(t, items, 5) for i, t, _ in rows}


def test_long_spans_are_cut_and_clean_texts_stay(spark, docs):
    passage = " ".join(f"w{i}" for i in range(60))
    filler = " ".join(f"é{i}" for i in range(3000))
    rows = [(1, f"{filler} {passage} end", "s"), (2, passage, "s"), (3, filler, None), (4, None, "s")]
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.remove_contamination(docs(rows), bench).collect()}
    assert set(got) == {1, 3, 4} and got[3] == filler and got[4] is None
    assert got[1].split() == f"{filler} end".split()
    assert decontaminate.remove_contamination(docs(rows), bench.limit(0)).count() == 4


def test_sharding_is_balanced_whole_and_gapless(spark, docs):
    rnd = random.Random(2)
    rows = [(i, "x" * rnd.randint(0, 400), "s") for i in range(1500)] + [(5000 + i, "copy " * 20, "hot") for i in range(900)] + EDGE
    out = sharding.shard_by_bytes(docs(rows).withColumn("shard", F.lit("clash")), 8, range_rows=40).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r["size"]
    small = [s for r, s in sizes.items()]
    total, largest = sum(small), max(r["size"] for r in out)
    assert max(small) - min(small) <= 0.02 * total / 8 + 2 * largest
    for k in range(8):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.crc) for r in out) == want
    assert sharding.shard_by_bytes(docs([])).count() == 0


def test_shards_hold_whole_rows_in_slot_order(spark, docs, tmp_path):
    rnd = random.Random(10)
    rows = [(i, "é" * rnd.randint(0, 400), f"s{i % 3}") for i in range(800)] + [(5000 + i, "copy " * 20, None) for i in range(300)] + EDGE
    given, path = docs(rows).withColumn("shard", F.lit("clash")), str(tmp_path / "shards")
    out, n = sharding.write_shards(given, 8, range_rows=40, path=path)
    assert n["shard"] == "_shard" and out.columns[:6] == given.columns
    assert Counter(map(tuple, out.select(*given.columns).collect())) == Counter(map(tuple, given.collect()))
    placed = {(r.doc_id, r.text): (r[n["shard"]], r[n["slot"]]) for r in out.collect() if r.doc_id not in (1, None)}
    digests = {(r.doc_id, r.crc): (r.shard, r.slot) for r in sharding.shard_by_bytes(given, 8, range_rows=40).collect()}
    assert all(digests[i, zlib.crc32((t or "").encode())] == at for (i, t), at in placed.items())
    slots = {}
    for file in sorted(tmp_path.glob("shards/*/*/*.parquet"), key=lambda f: [int(p.split("=")[1]) for p in f.parts[-3:-1]]):
        slots.setdefault(file.parts[-3], []).extend(pq.ParquetFile(file).read(["slot"])["slot"].to_pylist())
    assert set(slots) == {f"_shard={k}" for k in range(8)}
    assert all(s == list(range(len(s))) for s in slots.values())


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    rows = EDGE + [(100 + i, f"document {i} says <|endoftext|> hello, it's {i * 7919}! " * (i % 9), f"s{i % 4}") for i in range(80)]
    out = packing.pack(docs(rows), vocabulary_path(), sequence=64, window=256, with_ids=True).collect()
    seqs, pieces = {}, {}
    for r in out:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.source, r.doc_tokens), []).append((r.start, r.ids))
    last = max(seqs)
    for k, s in seqs.items():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))]
        assert k == last or sum(n for _, n in s) == 64
    assert sorted(seqs) == list(range(last + 1))
    for i, text, source in rows:
        want = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        got = sorted(pieces[(i, source, len(want) // 4)])
        if len({(x, y) for x, y in got}) == len(got):  # repeated rows come twice
            assert b"".join(x for _, x in got) == want
    assert packing.pack(docs([]), vocabulary_path()).count() == 0


def test_packing_ids_are_those_of_the_file_as_loaded(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    ids = lambda x: [*t.encode(x, add_special_tokens=False).ids, 0]
    rnd = random.Random(9)
    bits = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", " it's", "12", "é\U0001f600", "..."]
    texts = ["a <|endoftext|> b"] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20))) for _ in range(200)]
    encode = packing.encoder(vocabulary_path(), added_tokens=True)
    assert all([*encode(x).tolist(), 0] == ids(x) for x in texts) and 50256 in ids(texts[0])
    folder = str(tmp_path / "sf")
    docs([(i, x, "s") for i, x in enumerate(texts)]).write.parquet(f"{folder}/documents.parquet")
    pieces = {}
    for r in QUERIES["op3_packing"](spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for i, x in enumerate(texts):
        want = np.array(ids(x), "<u4")
        assert all(n == len(want) and crc == zlib.crc32(want[a:a + m].tobytes()) for a, m, crc, n in pieces[i])


@pytest.mark.parametrize("targets", [None, {f"s{k}": 1 + k % 3 for k in range(30)}])
def test_packing_keeps_targets_of_more_sources_than_queues(spark, docs, targets):
    rows = [(100 * k + i, "word " * 200, f"s{k}") for k in range(30) for i in range(10)] + [(9000 + i, "a b", None) for i in range(3)]
    out = packing.pack(docs(rows).repartition(3), vocabulary_path(), sequence=64, window=512, targets=targets, max_queues=4, with_ids=True).collect()
    taken = sorted((r.sequence_id * 64 + r.offset, r.length, r.source) for r in out)
    assert [a for a, _, _ in taken] == [sum(n for _, n, _ in taken[:i]) for i in range(len(taken))]
    per_doc = Counter()
    for r in out:
        per_doc[r.doc_id] += r.length
        assert zlib.crc32(r.ids) == r.ids_crc32
    assert all(per_doc[r.doc_id] == r.doc_tokens for r in out) and len(per_doc) == len(rows)
    early, goal = Counter(), 64 * 512  # before any source but the tiny one runs dry
    for at, n, s in taken:
        early[s] += max(0, min(n, goal - at))
    weights = {f"s{k}": (targets or {}).get(f"s{k}", 1) for k in range(30)}
    for s, w in weights.items():
        assert early[s] == pytest.approx(goal * w / sum(weights.values()), rel=0.2)


def test_schedule_keeps_proportions_and_carries_deficits():
    rnd = random.Random(3)
    for _ in range(60):
        tokens = [rnd.randint(0, 3000) for _ in range(rnd.randint(1, 7))]
        plan = packing.Schedule(tokens, [rnd.randint(1, 50) * 1000 for _ in tokens], 256)
        place = {}
        for q, n in enumerate(tokens):
            x = 0
            while x < n:
                m = min(n - x, rnd.randint(1, 500))
                for a, length, g in plan.slices(q, x, m):
                    for k in range(length):
                        place[g + k] = (q, a + k)
                x += m
        assert sorted(place) == list(range(sum(tokens)))
        for q, n in enumerate(tokens):  # each queue keeps its order
            assert [i for p, i in sorted((g, i) for g, (k, i) in place.items() if k == q)] == list(range(n))
    plan = packing.Schedule([1000, 3000], [1000, 3000], 100)
    for w in range(10):
        assert sum(min(n, 100) for _, n, g in plan.slices(0, 25 * w, 25)) == 25


def test_digest_of_edited_and_next_texts(spark, docs):
    texts = [f"{'lorem ipsum dolor ' * (i % 7 + 1)}{i}" for i in range(40)]
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)] + [(200, "é\U0001f600" * 9, "s"), (201, None, None), (202, "", "s")]
    got = {r.doc_id: r for r in digest.edited_likeness(docs(rows).withColumn("fingerprint", F.lit(0))).collect()}
    assert len(got) == len(rows)
    for (i, t, _), (_, nxt, _) in zip(rows, rows[1:] + rows[:1]):
        t, nxt, r = t or "", nxt or "", got[i]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        assert r.fingerprint == digest.fingerprint(t) and r.edited_fingerprint == digest.fingerprint(edited)
        assert r.near_next == digest.likeness(digest.fingerprint(t), digest.fingerprint(nxt))
        assert 0 <= r.near_edited <= 1
    assert digest.likeness(got[0].fingerprint, got[0].fingerprint) == 1
    assert digest.edited_likeness(docs(EDGE)).count() == len(EDGE) and digest.edited_likeness(docs([])).count() == 0


def test_language_model_matches_brute_force(spark, docs):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["The", "cat", "sat", "on", "é", "mat."]) for _ in range(rnd.randint(0, 30))), "s") for i in range(120)] + [(500, None, None)]
    out = {r.doc_id: r for r in language_model.scores(docs(rows), block_tokens=100, shard_bytes=500).collect()}
    words = {i: (t or "").encode().lower().split() + [b"\n"] for i, t, _ in rows}
    c = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        assert out[i].base_score == pytest.approx(sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert (out[i].n_tokens, out[i].n_known, out[i].train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 1) and out[i].score < 0
    assert language_model.scores(docs(EDGE)).count() == len(EDGE) and language_model.scores(docs([])).count() == 0


def test_em_weights_maximise_held_out_likelihood():
    cells = [(3, 40, 8, 50), (3, -9999, 16, 30), (3, -9999, -9999, 5)]
    w = language_model.learn(cells)[3]
    p = np.array([[2.0 ** 5, 2.0, 1], [0, 4.0, 1], [0, 0, 1]])
    like = lambda x: float((np.log(p @ x) * [50, 30, 5]).sum())
    assert w.sum() == pytest.approx(1)
    for _ in range(200):
        assert like(w) >= like(np.random.default_rng(_).dirichlet([1, 1, 1])) - 1e-6


def test_chat_round_trip_with_parts(spark):
    part = lambda kind, text=None, ref=None, **k: (kind, text, ref, k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    nasty = "\\ <|turn|>x<|body|> \\<|end|> </s>[INST] ok [/INST] <|image|> \\\\ é\U0001f600"
    rows = [(1, 0, "user", [part("text", nasty), part("image", ref="i.png", width=56, height=29), part("text", "see")]),
            (1, 1, "assistant", [part("text", nasty), part("text", None)]), (1, 2, "we\nird<|body|>", [part("audio", ref="a", seconds=2.0)]),
            (2, None, None, None), (None, 0, "assistant", [part("document", ref="d", pages=3), part("other")])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>").withColumn("formatted", F.lit("clash"))
    out = chat.format_chat(df)
    back = out.withColumn("raw", F.col("formatted").cast("binary")).select(
        "*", chat.read_back(F.col("formatted")).alias("back"), chat.under_loss(F.col("raw"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in back.collect()}
    assert [tuple(t) for t in got[1].back] == [("user", nasty + "<|image|>see"), ("assistant", nasty), ("we\nird<|body|>", "<|audio|>")]
    assert got[1].loss == nasty and [(a.kind, a.ref, a.tokens) for a in got[1].attachments] == [("image", "i.png", 4), ("audio", "a", 50)]
    assert [tuple(t) for t in got[2].back] == [("", "")] and got[2].loss == ""
    assert got[None].expanded_tokens == 3 * 512 + 1
    assert chat.format_chat(df.limit(0)).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_base(text):
    def luhn(d):
        s = [int(c) for c in reversed(d)]
        return sum(x if i % 2 == 0 else 2 * x - 9 * (2 * x > 9) for i, x in enumerate(s)) % 10 == 0

    def ok(k, v):
        d = re.sub("[^0-9]", "", v)
        return {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[k]

    return [f"{k}:{m.start()}:{m.end()}" for k in PATTERNS for m in re.finditer(PATTERNS[k], text or "") if ok(k, m.group())]


def test_pii_base_spans_match_brute_force(spark, docs):
    rnd = random.Random(6)
    bits = ["a@b.c", "%x@d.e.f", "@", "1.2.3.4", "256.1.1.1", "000255.0.0.1.7", "4111 1111-1111 1111", "4111111111111112", "+1 (743) 555-3824", "+12", " ", "é\U0001f600",
            ".", "-", "7", "_"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))), "s") for i in range(400)] + EDGE + [(900, "1" * 30000, "s"), (901, "a" * 30000 + "@x", "s")]
    marked, n = pii.personal_data(docs(rows).withColumn("base", F.lit("clash")))
    got = Counter((r.doc_id, r.w) for r in marked.select("doc_id", pii.written(F.col(n["base"])).alias("w")).collect())
    assert got == Counter((i, ",".join(brute_base(t))) for i, t, _ in rows)


def test_overlapping_spans_go_as_a_whole(spark, docs):
    rnd = random.Random(12)
    bits = ["10.0.0.4 111111111111111", "4111 1111-1111 1111", "1.2.3.4", "a@b.c", "+1 (743) 555-3824", " ", "x", "7", "-", ".", "\U0001f600"]
    rows = [(0, "from 10.0.0.4 111111111111111 on", "s"), (1, "1.2.3.4 and a@b.c", "s")]
    rows += [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))), "s") for i in range(2, 300)]
    out = {r.doc_id: r.text for r in pii.sanitised(docs(rows), min_joint=1000).collect()}
    assert out[0] == "from [IP] on" and out[1] == "[IP] and [EMAIL]"
    for i, t, _ in rows:
        spans = sorted(((int(a), -int(b), k) for k, a, b in (x.split(":") for x in brute_base(t))))
        want, at = "", 0
        for a, b, k in spans:
            want += t[at:a] + f"[{k.upper()}]" if a >= at else ""
            at = max(at, -b)
        assert out[i] == want + t[at:]


def test_disclosing_terms_are_removed(spark, docs):
    rnd = random.Random(7)
    filler = lambda: " ".join(rnd.choice(["green", "blue", "house", "river", "stone"]) for _ in range(12))
    rows = [(i, f"{filler()} {i}", "s") for i in range(300)]
    rows += [(1000 + i, f"{filler()} Zorblax writes from z.b@mail.example.com {filler()} {i}", "s") for i in range(6)]
    rows += [(2000, "Zorblax was here, zorblax-like", "s"), (2001, None, None), (2002, "", "s")]
    out = {r.doc_id: r.text for r in pii.sanitised(docs(rows)).collect()}
    assert len(out) == len(rows) and out[5] == rows[5][1] and out[2001] is None
    assert "orblax" not in out[1000] and "[EMAIL]" in out[1000] and "@" not in out[1000]
    assert out[2000] == " was here, zorblax-like"
    assert pii.sanitised(docs([])).count() == 0


def test_terms_far_from_a_value_disclose_it(spark, docs):
    rnd = random.Random(11)
    words = [f"{a}{b}{c}o" for a in "bdgk" for b in "aeiu" for c in "lmnr"]
    filler = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    rows = [(i, f"{filler(40)} {i}", "s") for i in range(300)]
    rows += [(1000 + i, f"Zorblax {filler(60)} z.b@mail.example.com {i}", "s") for i in range(5)]
    # Texts of a value with no word at all count in its df: the word of four of eight does not give it away.
    rows += [(2000 + i, f"Quux {filler(30)} +1 (386) 555-3733 {i}", "s") for i in range(4)]
    rows += [(2100 + i, f"+1 (386) 555-3733 {i}", "s") for i in range(40)]
    rows += [(1000, rows[300][1], "s")]  # a copy counts once
    texts = {t for _, t, _ in rows}
    entities, terms = {}, {}
    for t in texts:
        for m in filter(None, brute_base(t)):
            k, a, b = m.split(":")
            entities.setdefault((k, t[int(a):int(b)]), set()).add(t)
        for w in set(re.findall(r"[^\W\d_][^\W\d_'’-]{2,}", t.lower())):
            terms.setdefault(w, set()).add(t)
    share, n = {}, len(texts)
    for es in entities.values():
        for w, ts in terms.items():
            both = len(es & ts)
            if both >= 3 and len(es) >= 3:
                share[w] = max(share.get(w, 0), log10(both * n / (len(es) * len(ts))) / log10(n / len(es)))
    given = docs(rows).select(F.xxhash64("text").alias("h"), "text", pii.base_spans(F.col("text")).alias("base"))
    got = {r.term: r.share for r in pii.disclosing_terms(given, 3, 0.75)[0].collect()}
    assert got == pytest.approx({w: x for w, x in share.items() if x >= 0.75}) and "zorblax" in got
    out = {r.doc_id: r.text for r in pii.sanitised(docs(rows)).collect()}
    assert "orblax" not in out[1000]


def test_quality_learns_rules_and_holds_out(spark):
    d, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    model = quality.train(d, labels)
    out, score = quality.scored(d.withColumn("score", F.lit("clash")), model)
    assert score == "_score"
    pairs = out.join(labels, "doc_id").select(score, "quality").collect()
    assert np.mean([(s >= 0.3) == bool(q) for s, q in pairs]) > 0.9
    edge, score = quality.scored(spark.createDataFrame([(None,), ("",), ("a",)], "text string"), model)
    assert all(0 <= r[score] <= 1 for r in edge.collect())
    clash = d.limit(20).withColumns({"label": F.lit("x"), "lid": F.lit("y"), "t": F.lit(1), "stat_entropy": F.lit("z")})
    assert quality.train(clash, labels.limit(0)).rules == ()
    scored, _ = quality.scored(clash, model)
    assert scored.count() == 20 and set(clash.columns) < set(scored.columns)


def test_toxicity_separates_and_orders(spark, docs):
    rnd = random.Random(8)
    word = lambda: rnd.choice(["tree", "cloud", "paper", "walk", "green", "seven"])
    rows, marks = [], []
    for i in range(400):
        k = rnd.choice([0, 0, 0, 1, 3, 6])
        rows.append((i, " ".join([word() for _ in range(30)] + ["scumbag"] * k), "s"))
        marks.append((i, 1, int(k > 0)))
    labels = docs([]).sparkSession.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(rows), labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    severity = model.above([" ".join(["tree"] * 30 + ["scumbag"] * k) for k in (0, 1, 3, 6)]).sum(axis=1)
    assert list(severity) == sorted(severity) and severity[0] < 0.3 < 0.9 < severity[1]
    out, n = toxicity.scored(docs(EDGE).withColumn("severity", F.lit(0)), model)
    assert n["severity"] == "_severity" and out.count() == len(EDGE)
    clash = docs(rows).withColumns({"label": F.lit("x"), "lid": F.lit("y"), "row": F.lit(1)})
    toxicity.scored(docs(EDGE), toxicity.train(clash, labels.limit(0)))[0].collect()
