import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lumenlink.llm import common, queries, suffix
from lumenlink.llm.induced import Sorter


def slow(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[(i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_query_is_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    assert got(queries.op5_suffix(spark, sf)) == slow(rows)


def test_awkward_rows(awkward, awkward_rows):
    assert got(suffix.dedup(awkward)) == slow([r[:2] for r in awkward_rows])


def test_kept_bytes(awkward):
    for r in suffix.dedup(awkward, keep_text=True).where("kept is not null").collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_empty_table(nothing):
    assert suffix.dedup(nothing).collect() == []


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_segments_cover_each_start_once(block, monkeypatch):
    monkeypatch.setattr(suffix, "_BLOCK", block)
    rng = random.Random(block)
    text = bytes(rng.choice(b"ab ") for _ in range(2500)) + b"c" * 400
    _, lo, hi, _ = suffix.segments(text)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi, strict=True)])
    assert (starts == np.arange(len(text) - 199)).all()


def test_induced_order_and_common_prefixes(tmp_path):
    """Suffix order and common prefixes against plain sorting, with queues in memory and on disk."""
    rng = random.Random(3)
    for _ in range(300):
        k, t = rng.choice([1, 2, 3, 10]), []
        for _ in range(rng.randint(1, 4)):
            t += [rng.randint(1, k) for _ in range(rng.randint(1, rng.choice([5, 30, 80])))] + [0]
        b, cap = bytes(t), rng.choice([2, 5, 17, 30])
        places = []
        for pos, lcp in Sorter(np.array(t, np.uint8), cap, str(tmp_path), rng.choice([4, 1 << 24])).buckets():
            cut = [b[p:].split(b"\0")[0][:cap] for p in pos]
            places += pos.tolist()
            for x, y, n in zip(cut, cut[1:], lcp[1:], strict=False):
                same = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
                assert x <= y and n == same
        assert sorted(places) == [i for i, x in enumerate(t) if x]
