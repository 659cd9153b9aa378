import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenlink.llm import common, queries, sharding


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n))).T
    index = sharding.hilbert_index(cells, bits).astype(int)
    assert sorted(index) == list(range(cells.shape[1]))
    walk = cells[:, np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=1)).sum(axis=0) == 1).all()


def check(rows, docs, n_shards=40):
    want = Counter((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(n_shards)]
    assert set(slots) <= set(range(n_shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def slow_curve(point, bits):
    """Place on the curve by walking the cube from the largest octant down: rotate and reflect as Skilling's axes do, in plain loops."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    q = 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_query_is_brute_force(spark, sf):
    """Every row's shard and slot: cells in plain Python (but for Spark's hash), one sort, forty cuts."""
    docs = common.table(spark, sf, "documents")
    cells = {r[0]: tuple(r)[1:] for r in docs.select("doc_id", sharding.name_cells(F.col("lang"), 6), sharding.name_cells(F.col("source"), 6)).collect()}
    rows = []
    for d in docs.collect():
        raw = (d.text or "").encode()
        size = len(raw) + 16
        rows.append((slow_curve((*cells[d.doc_id], min(63, int(np.floor(np.log2(size) * 2.5)))), 6), d.doc_id, zlib.crc32(raw)))
    rows.sort()
    small, extra = divmod(len(rows), 40)
    want, at = {}, 0
    for shard in range(40):
        for slot in range(small + (shard < extra)):
            want[rows[at][1]] = (shard, slot)
            at += 1
    assert {r.doc_id: (r.shard, r.slot) for r in queries.op10_sharding(spark, sf).collect()} == want


def test_query_law(spark, sf):
    rows = queries.op10_sharding(spark, sf).collect()
    check(rows, common.table(spark, sf, "documents").collect())
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_awkward_rows(awkward, nothing):
    check(sharding.shard_documents(awkward).collect(), awkward.collect())
    check(sharding.shard_documents(awkward, 7).collect(), awkward.collect(), 7)
    assert sharding.shard_documents(nothing).collect() == []


def test_shards_follow_the_curve_and_prune(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    placed = sharding.shard_documents(docs, 20)
    rows = sorted(placed.collect(), key=lambda r: (r.shard, r.slot))
    assert all(a.curve <= b.curve for a, b in itertools.pairwise(rows))
    sizes = sharding.manifest(placed, ["size"]).collect()
    spread = sum(np.log2(r.max_size / r.min_size) for r in sizes) / len(sizes)
    all_sizes = [r["size"] for r in rows]
    assert len(sizes) == 20 and sum(r.rows for r in sizes) == len(rows)
    assert spread < 0.8 * np.log2(max(all_sizes) / min(all_sizes))


def test_written_shards_hold_whole_rows(awkward, nothing, tmp_path, spark):
    """Clashing names, repeated rows, nulls; each shard's rows in one run of gapless slots."""
    clash = awkward.withColumns({"shard": F.lit("mine"), "slot": F.col("doc_id"), "_crc": F.lit(1), "curve": F.lit("c"), "row": F.lit("r"), "_cell": F.lit(0)})
    for k, docs in enumerate((awkward, clash)):
        path = f"file://{tmp_path}/shards{k}"
        shard, slot = sharding.write_shards(docs, path, 5)
        assert (shard, slot) == (("shard", "slot"), ("shard_", "slot_"))[k]
        back = spark.read.parquet(path)
        rows = back.collect()
        assert Counter(tuple(r[c] for c in docs.columns) for r in rows) == Counter(tuple(r) for r in docs.collect())
        slots = defaultdict(list)
        for r in rows:
            slots[r[shard]].append(r[slot])
        assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(slots) == 5
    sharding.write_shards(nothing, f"file://{tmp_path}/none", 5)
    assert not list((tmp_path / "none").glob("shard=*"))
    assert sharding.manifest(sharding.shard_documents(nothing), ["size"]).collect() == []
