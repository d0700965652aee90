"""Work and memory that grow with the input alone: planted sizes, no data of that size needed."""

import random
import time

import numpy as np
import pytest

from contrail.llm import decontaminate, packing, sharding, simhash


def brute_windows(items, words, window):
    hit, met = [0] * len(words), set()
    for name, item in items:
        m = min(window, len(item))
        for s in range(len(item) - m + 1 if item else 0):
            for i in range(len(words) - m + 1):
                if words[i:i + m] == item[s:s + m]:
                    met.add(name)
                    hit[i:i + m] = [1] * m
    return hit, met


def test_automaton_matches_brute_force_on_repetitive_items():
    rnd = random.Random(1)
    for _ in range(1500):
        window, letters = rnd.randint(1, 5), [b"a", b"b", b"c", b"d"][:rnd.randint(1, 4)]
        items = [(str(rnd.randint(0, 5)), [rnd.choice(letters) for _ in range(rnd.randint(0, 9))]) for _ in range(rnd.randint(0, 5))]
        words = [rnd.choice([*letters, b"z"]) for _ in range(rnd.randint(0, 25))]
        spans, met = decontaminate.Automaton(items, window).scan(words)
        hit = [0] * len(words)
        for a, b in spans:
            hit[a:b] = [1] * (b - a)
        assert (hit, met) == brute_windows(items, words, window)


def test_automaton_of_one_repeated_word_is_linear():
    start = time.perf_counter()
    spans, met = decontaminate.Automaton([("x", [b"a"] * 100_000)], 13).scan([b"a"] * 100_000)
    assert spans == [(0, 100_000)] and met == {"x"} and time.perf_counter() - start < 5


def test_a_worker_keeps_one_automaton():
    a = decontaminate.built([("x", b"a b c")], 2)
    assert decontaminate.built([("x", b"a b c")], 2) is a
    assert decontaminate.built([("x", b"a b d")], 2) is not a and decontaminate.built([("x", b"a b c")], 2) is not a


def test_splitters_of_100_000_ranges_without_square_work(monkeypatch):
    """The histogram is computed from planted rows in numpy; everything else is the operator's own work."""
    rng = np.random.default_rng(3)
    key = rng.integers(-(1 << 63), (1 << 63) - 1, 2_000_000, np.int64)
    key[:500_000] = key[0]  # a quarter of the rows are copies of one text
    tie, size = rng.permutation(len(key)).astype(np.int64), rng.integers(1, 2000, len(key))
    order = np.lexsort((tie, key))
    key, tie, size = key[order], tie[order], size[order]
    below_bytes = np.concatenate([[0], np.cumsum(size)])
    hot = int(np.bincount(np.unique(key, return_inverse=True)[1]).argmax())
    hot_key = int(np.unique(key)[hot])
    first = int(np.searchsorted(key, hot_key))
    rounds = []

    def histogram(rows, probes):
        rounds.append(len(probes))
        at = np.searchsorted(key, [k for k, _ in probes], "left")
        inside = np.array([k == hot_key for k, _ in probes])
        at[inside] = first + np.searchsorted(tie[key == hot_key], [t for k, t in probes if k == hot_key])
        return below_bytes[at].tolist(), at.tolist()

    class Rows:
        def agg(self, *_):
            return self

        def first(self):
            return int(size.sum()), len(key), int(key[0]), int(key[-1]), int(tie.min()), int(tie.max())

    monkeypatch.setattr(sharding, "histogram", histogram)
    monkeypatch.setattr(sharding.F, "coalesce", lambda *_: None)
    for f in ("sum", "count", "min", "max", "lit"):
        monkeypatch.setattr(sharding.F, f, lambda *_: None)
    parts, per = 100_000, 12_500
    start = time.perf_counter()
    splitters, below = sharding.find_splitters(Rows(), parts, per)
    seconds = time.perf_counter() - start
    got = np.diff([0, *below_bytes[below], below_bytes[-1]])
    assert splitters == sorted(splitters) and seconds < 10 and sum(rounds) < 40 * parts
    assert abs(got.reshape(8, per).sum(axis=1) / (size.sum() / 8) - 1).max() < 0.005
    assert got.max() < 2 * size.sum() / parts + 2000


def test_shards_within_the_tolerance(spark, docs):
    rnd = random.Random(8)
    rows = [(i, "x" * rnd.randint(0, 400), "s") for i in range(3000)] + [(9000 + i, "same text " * 20, "s") for i in range(1500)]
    out = sharding.shard_by_bytes(docs(rows), shards=4, range_rows=50, tolerance=0.002).collect()
    size = np.bincount([r.shard for r in out], weights=[r["size"] for r in out], minlength=4)
    assert len(out) == len(rows) and abs(size / size.mean() - 1).max() < 0.004 + 400 / size.mean()
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


@pytest.mark.parametrize("distance,max_bucket", [(0, 1), (1, 1), (1, 64), (3, 1), (3, 64), (4, 1)])
def test_simhash_links_at_any_distance(spark, distance, max_bucket):
    rnd = random.Random(distance)
    fps = {0}
    while len(fps) < 60:
        x = rnd.choice([0, rnd.choice(sorted(fps)), rnd.getrandbits(64)])
        for _ in range(rnd.randint(0, 4)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(simhash._signed(x), i) for i, x in enumerate(fps)], "fp long, node long")
    found = {frozenset((r.u, r.v)) for r in simhash.links(nodes, distance, max_bucket).collect()}
    root = {i: i for i in range(len(fps))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j, b in enumerate(fps[:i]):
            if (a ^ b).bit_count() <= distance:
                root[max(top(i), top(j))] = min(top(i), top(j))
    want = [top(i) for i in range(len(fps))]
    assert all((fps[min(p)] ^ fps[max(p)]).bit_count() <= distance for p in found)
    root = {i: i for i in range(len(fps))}
    for p in found:
        a, b = sorted((top(min(p)), top(max(p))))
        root[b] = a
    assert [top(i) for i in range(len(fps))] == want


def test_a_window_in_which_a_queue_runs_dry_keeps_the_others_deficits():
    plan = packing.Schedule([100, 50_000, 50_000], [333, 333, 334], 1000)
    served = [[0] * 98, [0] * 98]
    for q in (1, 2):
        for _, n, at in plan.slices(q, 0, 40_000):
            served[q - 1][at // 1000] += n
    both = np.cumsum(served, axis=1)[:, 1:75]
    share = 333 / 667
    assert np.abs(both[0] / both.sum(axis=0) - share).max() < 0.001
