import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from lumenlink.llm import common, graph, queries, simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(fps, radius=3):
    """Least reachable node of each distinct fingerprint, by comparing all pairs."""
    nodes = sorted(set(fps))
    root = {f: f for f in nodes}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, x in enumerate(nodes):
        for y in nodes[i + 1 :]:
            if (x ^ y).bit_count() <= radius:
                root[max(top(x), top(y))] = min(top(x), top(y))
    return {f: top(f) for f in nodes}


def expected(rows):
    fp = [(i, slow_fingerprint(t)) for i, t in rows]
    of = slow_classes([f for _, f in fp])
    least = defaultdict(list)
    for i, f in fp:
        if i is not None:
            least[of[f]].append(i)
    return Counter((i, f"{f:016x}", min(least[of[f]], default=None)) for i, f in fp)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_query_is_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    assert got(queries.op1_simhash(spark, sf)) == expected(rows)


def test_awkward_rows(awkward, awkward_rows):
    assert got(simhash.near_duplicates(awkward)) == expected([r[:2] for r in awkward_rows])


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.keep_one(nothing).collect() == []


def test_shingle_counts_beyond_a_lane():
    text = ("aa bb " * 40_000 + "cc dd ee ff").encode()
    assert simhash.fingerprint(text) == slow_fingerprint(text.decode())


@pytest.mark.parametrize("hot", [2, 5, 512])
def test_dense_balls_at_any_bucket_limit(spark, hot):
    """Chains and balls of fingerprints; small limits drive all buckets through the finer blocks and the lookup."""
    rng = np.random.default_rng(hot)
    fps = set()
    for _ in range(12):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(14):
            fps.add(x)
            for b in rng.integers(0, 64, int(rng.integers(1, 6))):
                x ^= 1 << int(b)
    fps |= {1 << b for b in range(64)} | {0, 2**64 - 1}
    want = slow_classes(fps)
    signed = {f: int(np.uint64(f).view(np.int64)) for f in fps}
    table = spark.createDataFrame([(i, s) for i, s in enumerate(signed.values())], "doc_id long, fp long")
    id_of = {s: i for i, s in enumerate(signed.values())}
    groups = defaultdict(set)
    for f, r in want.items():
        groups[r].add(id_of[signed[f]])
    out = {r.doc_id: r.component_id for r in simhash.classes(table, hot=hot).collect()}
    assert out == {i: min(g) for g in groups.values() for i in g}


def test_pivots_discard_no_near_pair():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
    table = simhash.pivot_table(np.concatenate([a, b]))
    i, _ = simhash.survivors(table, np.arange(500), np.arange(500, 1000))
    assert len(i) == 500
    i, _ = simhash.survivors(table, np.arange(499), np.arange(1, 500))
    assert len(i) < 5  # unrelated pairs go


def test_components_are_least_reachable(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    out = {r.a: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {x: top(x) for x in root if top(x) != x}


def test_keep_one(awkward):
    rows = simhash.keep_one(awkward)
    assert rows.columns == awkward.columns
    ids = Counter(r.doc_id for r in rows.collect())
    assert ids[-5] == 1 and not ids.keys() & {1, 2, 3}  # copies and the near copy of the least id
    assert all(ids[i] == 1 for i in (7, 8, 9, 10, 13, 14))


def test_cover_joins_what_all_pairs_join():
    """Chains: rows near each other that follow different leaders, in any order."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(6):
        x = rng.integers(0, 2**64, simhash.LANES, dtype=np.uint64)
        for _ in range(25):
            rows.append(x)
            x = x.copy()
            for lane in range(simhash.LANES):
                for b in rng.integers(0, 64, int(rng.integers(1, 12))):
                    x[lane] ^= np.uint64(1) << np.uint64(b)
    fps = np.array(rows)[rng.permutation(len(rows))]
    sizes = rng.integers(90, 115, len(fps))
    want_a, want_b = [], []
    for i in range(len(fps)):
        for j in range(i):
            lane = int(fps[i, 0] ^ fps[j, 0]).bit_count()
            if sum(int(x).bit_count() for x in fps[i] ^ fps[j]) <= 240 and lane <= simhash.LANE_RADIUS and min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j]):
                want_a.append(i)
                want_b.append(j)
    want = simhash._forest(len(fps), np.array(want_a), np.array(want_b))
    assert 6 < len(set(want)) < len(fps)
    assert (simhash._forest(len(fps), *simhash._cover(fps, sizes, 240)) == want).all()


def test_copies_are_alike_by_brute_force(spark):
    """Classes against exact likeness of the five-word shingle sets: links well above 0.8 hold, none well below."""
    sf = "/root/testdata/sf0.01"
    df = common.table(spark, sf, "documents")
    sets = {r.doc_id: frozenset(simhash.shingle_hashes((r.text or "").encode(), 5)) for r in df.collect()}
    out = {r.doc_id: r.component_id for r in simhash.copy_classes(df).collect()}
    assert out.keys() == sets.keys()
    bearers = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            bearers[x].append(i)
    best = Counter()
    for i, s in sets.items():
        for j, c in Counter(j for x in s for j in bearers[x] if j != i).items():
            like = c / (len(s) + len(sets[j]) - c)
            if like >= 0.85:
                assert out[i] == out[j], (i, j, like)
            if out[i] == out[j]:
                best[i] = max(best[i], like)
    size = Counter(out.values())
    assert all(best[i] >= 0.72 for i in out if size[out[i]] > 1 and sets[i])


def test_leaders_link_a_large_group(spark):
    """A group of near copies larger than the bucket limit is one class."""
    from tests.llm.conftest import prose

    words = prose(11, 500).split(" ")
    rows = [(i, " ".join([*words[: 3 * i], f"w{i}", *words[3 * i + 1 :]])) for i in range(60)] + [(99, prose(12, 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in simhash.copy_classes(df, hot=8).collect()}
    assert out == {i: 0 for i in range(60)} | {99: 99}


def _likeness_pairs(df):
    """doc_id to its class by exact likeness of five-word shingle sets, every pair compared."""
    sets = {r.doc_id: frozenset(simhash.shingle_hashes((r.text or "").encode(), 5)) for r in df.collect()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    bearers = defaultdict(list)
    for i, s in sets.items():
        for x in s or {None}:
            bearers[x].append(i)
    for i, s in sets.items():
        for j, c in Counter(j for x in s or {None} for j in bearers[x] if j < i).items():
            if not s or 5 * c >= 4 * (len(s) + len(sets[j]) - c):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in sets}


def test_classes_are_exact(spark):
    df = common.table(spark, "/root/testdata/sf0.01", "documents")
    assert {r.doc_id: r.component_id for r in simhash.copy_classes(df).collect()} == _likeness_pairs(df)


@pytest.mark.parametrize("hot", [4, 512])
def test_short_texts_are_decided_exactly(spark, hot):
    """Sets of 4 to 70 shingles, likeness just above, at and below 0.8."""
    rows = []
    for k in range(60):
        n = 4 + k % 67
        words = [f"w{k}x{i}" for i in range(n + 4)]
        for more in (n // 4, n // 4 + 1):  # n of n + more shingles are shared: 0.8 or just under
            rows.append(words + [f"v{k}y{more}z{i}" for i in range(more)])
        rows += [words, [*words[:-1], f"last{k}"]]
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.copy_classes(df, hot=hot).collect()} == _likeness_pairs(df)
