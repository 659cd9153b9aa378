"""SimHash near-duplicates through pivot distance tables.

Fingerprints: 64-bit SimHash of word shingles (bit set if set in over half of
the shingles' XXH64 values). Linked pairs (few differing bits) are found so:

1. Distinct fingerprints only; copies share one.
2. Blocking without loss: the 64 bits are cut into 6 blocks. At most 3
   differing bits touch at most 3 blocks, so a linked pair agrees on some 3
   blocks: 20 choices, 31 to 33 common bits each. (Random pivots cannot key the
   search by themselves: each keeps 46 % of unrelated pairs at this radius, so
   a grid over them would be quadratic.)
3. In a block's bucket, the pivot distance table (Hamming distances to fixed
   reference fingerprints, made once per fingerprint) discards the pairs whose
   largest coordinate difference exceeds the radius - by the triangle
   inequality no linked pair - and the survivors are verified.
4. Buckets with more fingerprints than ``hot`` are not paired: the other 32 bits
   are cut into 6 blocks again, which gives buckets in which 16 bits at most
   differ. These hold 65,536 distinct fingerprints at most, and large ones are
   searched by looking up each fingerprint's neighbours in a bitmap.
5. Per bucket only a spanning forest is emitted; components by star contraction.
"""

from __future__ import annotations

from itertools import combinations, groupby, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common, graph

RADIUS = 3
N_PIVOTS = 16
HOT = 512
_LANES = np.uint64(0x0001000100010001)
_CHUNK = 65_535  # what a 16-bit lane can count


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, n_words: int = 3):
    """XXH64 (seed 42) of each word shingle: A-Z lower-cased, words between ASCII white space, joined by one space."""
    words = text.lower().split()
    if not words:
        return iter(())
    grams = zip(*(islice(words, i, None) for i in range(n_words)), strict=False) if len(words) >= n_words else [words]
    return map(xxh64_intdigest, map(b" ".join, grams), repeat(42))


def fingerprint(text: bytes, n_words: int = 3) -> int:
    """The SimHash; 0 if there are no words."""
    hashes = shingle_hashes(text, n_words)
    counts, total = [0] * 64, 0
    while True:
        h = np.fromiter(islice(hashes, _CHUNK), np.uint64)
        for j in range(16 if len(h) else 0):
            lanes = int(((h >> np.uint64(j)) & _LANES).sum())  # four counters in one sum
            for k in range(4):
                counts[j + 16 * k] += (lanes >> (16 * k)) & 0xFFFF
        total += len(h)
        if len(h) < _CHUNK:
            break
    return sum(1 << b for b in range(64) if 2 * counts[b] > total)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row; null counts as the empty text."""

    def run(batch):
        fps = np.array([fingerprint(t, n_words) for t in common.utf8(batch)], np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64))}

    return common.map_arrow(common.id_and_text(docs, id_col, text_col), run, "doc_id long, fp long")


# ---------------------------------------------------------------- pivots and links


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints."""
    return np.random.default_rng(20240229).integers(0, 2**64, n, dtype=np.uint64)


def pivot_table(fps: np.ndarray, n: int = N_PIVOTS) -> np.ndarray:
    """Hamming distances (pivot x fingerprint)."""
    return np.stack([np.bitwise_count(fps ^ p) for p in pivots(n)]).astype(np.int8)


def survivors(table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose pivot coordinates all differ by ``radius`` at most."""
    for row in table:
        near = np.abs(row[a] - row[b]) <= radius
        a, b = a[near], b[near]
        if not len(a):
            break
    return a, b


def _cuts(bits: int, parts: int = 6) -> list[int]:
    """Masks of ``parts`` runs of ``bits`` bits, of nearly equal widths."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(1 << e) - (1 << s) for s, e in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def first_masks() -> list[int]:
    return [sum(m) for m in combinations(_cuts(64), 3)]


def second_masks(first: int) -> list[int]:
    """For the bits outside ``first``, cut into 6 runs: ``first`` with each choice of 3 of them."""
    rest = [b for b in range(64) if not first >> b & 1]
    runs = [sum(1 << rest[i] for i in range(len(rest)) if c >> i & 1) for c in _cuts(len(rest))]
    return [first | sum(m) for m in combinations(runs, 3)]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches."""
    lab = np.arange(n)
    while len(a):
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, a, low)
        np.minimum.at(lab, b, low)
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up
        apart = lab[a] != lab[b]
        a, b = a[apart], b[apart]
    return lab


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints: one word each, or a row of words."""
    bits = np.bitwise_count(x ^ y)
    return bits if bits.ndim == 1 else bits.sum(axis=1, dtype=np.int16)


def _bucket_links(key: np.ndarray, fps: np.ndarray, radius: int, pair_up_to: int, large, table: np.ndarray | None = None, may=None, sure=None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, root row) of whole buckets; rows are sorted by ``key``.

    ``large(first, size)`` links the rows of a larger bucket. ``table`` is the
    pivot distance table (fixed pivots if not given); ``may(a, b)`` marks the
    pairs that are let through to it, ``sure(a, b)`` those of them that are linked uncompared.
    """
    n = len(fps)
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[edge, n])
    small = np.repeat(size <= pair_up_to, size)
    table = pivot_table(fps) if table is None else table
    found_a, found_b = [], []
    at = np.flatnonzero(small)
    group = np.repeat(np.arange(len(size)), size)
    for step in range(1, pair_up_to):
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        a = at[may(at, at + step)] if may else at
        if sure:
            known = sure(a, a + step)
            found_a.append(a[known])
            found_b.append(a[known] + step)
            a = a[~known]
        a, b = survivors(table, a, a + step, radius)
        near = _distance(fps[a], fps[b]) <= radius
        found_a.append(a[near])
        found_b.append(b[near])
    for s, m in zip(edge[size > pair_up_to], size[size > pair_up_to], strict=True):
        a, b = large(s, m)
        found_a.append(a + s)
        found_b.append(b + s)
    lab = _forest(n, np.concatenate(found_a or [np.zeros(0, int)]), np.concatenate(found_b or [np.zeros(0, int)]))
    moved = np.flatnonzero(lab != np.arange(n))
    return moved, lab[moved]


def _lookup(fps: np.ndarray, mask: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All links among distinct fingerprints that differ in few positions only, by looking up every neighbour."""
    free = [b for b in range(64) if not mask >> b & 1]
    code = np.zeros(len(fps), np.int64)
    for i, b in enumerate(free):
        code |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    place = np.full(1 << len(free), -1, np.int64)
    place[code] = np.arange(len(fps))
    a, b = [], []
    for r in range(1, radius + 1):
        for flips in combinations(range(len(free)), r):
            other = place[code ^ sum(1 << f for f in flips)]
            hit = np.flatnonzero(other > np.arange(len(fps)))
            if len(hit):
                a.append(hit)
                b.append(other[hit])
    return np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])


def _array(col: pa.Array) -> np.ndarray:
    """Longs; of wide fingerprints, a row of words each."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(len(col), -1) if pa.types.is_binary(col.type) else col.to_numpy()


def _by_bucket(buckets: DataFrame, keys: tuple[str, str], find) -> DataFrame:
    """Links from all rows of each bucket: ``find(key, columns)`` gets whole buckets, sorted, and returns long arrays a and b."""
    names = buckets.columns

    def run(batches):
        held = None

        def out(cols):
            pair = np.stack([cols[names.index(k)] for k in keys])
            _, key = np.unique(pair, axis=1, return_inverse=True)
            order = np.argsort(key, kind="stable")
            a, b = find(key[order], {n: c[order] for n, c in zip(names, cols, strict=True)})
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [_array(batch.column(c)) for c in names]
            if held:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            k = [now[names.index(x)] for x in keys]
            cut = int(np.argmax((k[0] == k[0][-1]) & (k[1] == k[1][-1])))  # the last bucket may go on in the next batch
            if cut:
                yield out([x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held:
            yield out(held)

    n = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return buckets.repartition(n, *keys).sortWithinPartitions(*keys, *[c for c in names if c not in keys]).mapInArrow(run, "a long, b long")


def _links_of(buckets: DataFrame, radius: int, pair_up_to: int) -> DataFrame:
    """Links between the fingerprints of (m, k, fp) rows: m is the mask, k the masked bits."""

    def find(key, cols):
        fps = cols["fp"].view(np.uint64)
        at, root = _bucket_links(key, fps, radius, pair_up_to, lambda s, m: _lookup(fps[s : s + m], int(cols["m"].view(np.uint64)[s]), radius))
        return cols["fp"][at], cols["fp"][root]

    return _by_bucket(buckets, ("m", "k"), find)


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    return fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("m")).select("m", F.col("m").bitwiseAND(F.col("fp")).alias("k"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """A spanning set of the links between distinct fingerprints (long column fp): long columns a and b.

    Every linked pair is joined by a path of links; pairs within a bucket are
    not spelled out.
    """
    if radius > 3:
        raise ValueError("the blocking holds for radius 3 at most")
    keyed = _keyed(fps, first_masks())
    shared = keyed.groupBy("m", "k").agg(F.count("*").alias("n")).where("n > 1")
    kept = common.materialize(keyed.join(shared, ["m", "k"]), "buckets")
    pairs = _links_of(kept.where(F.col("n") <= hot).select("m", "k", "fp"), radius, hot)
    large = kept.where(F.col("n") > hot).select(F.col("m").alias("m1"), "fp")
    if large.limit(1).count():
        finer = [F.when(F.col("m1") == _signed(m), F.array(*[F.lit(_signed(x)) for x in second_masks(m)])) for m in first_masks()]
        again = large.select("fp", F.explode(F.coalesce(*finer)).alias("m")).select("m", F.col("m").bitwiseAND(F.col("fp")).alias("k"), "fp").distinct()
        pairs = pairs.unionByName(_links_of(again, radius, hot))
    return pairs


def classes(fps: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """doc_id, fp and component_id (least doc_id that links reach) from (doc_id, fp) rows, a row for each.

    Null ids do not count as least ids; a component of null ids only has a null
    component_id. Repeated rows and an empty table are fine.
    """
    fps = common.materialize(fps.select("doc_id", "fp"), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    reach = graph.components(links(distinct.select("fp"), radius, hot))
    rooted = distinct.join(reach.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = common.materialize(rooted, "rooted")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(of_root, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp", "left").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    out = classes(fingerprints(docs, id_col, text_col, n_words), radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- near copies of texts

SHINGLE = 5
SKETCH = 8
DEEP = 16  # least hashes of which a second one is asked for where the first is borne by many
LANES = 32
COPY_RADIUS = 310  # of 2,048 bits: so many differ on average where sets of one size are alike to 0.8
SLACK = 100  # bits more that a pair may differ in to be looked at: six standard deviations
SMALL = 64  # sets up to this size are looked at whatever their SimHashes: these tell too little
LANE_RADIUS = 24  # of the first 64: five standard deviations more than there
SIZE_RATIO = 0.8  # sets of which one is smaller than this part of the other are not alike to 0.8
N_REFERENCES = 4
_BYTES = np.uint64(0x0101010101010101)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of LANES x 64 bits over distinct hashes, each remixed for every lane."""
    lanes = np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    count = np.zeros((8, LANES, 8), np.int64)  # shift, lane, byte
    for i in range(0, len(hashes), 255):  # what a byte can count
        x = hashes[i : i + 255, None] + lanes
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        for j in range(8):
            count[j] += ((x >> np.uint64(j)) & _BYTES).sum(axis=0).view(np.uint8).reshape(LANES, 8)
    return np.packbits(2 * count > len(hashes)).view(np.uint64)


def sketches(docs: DataFrame, n_words: int = SHINGLE, size: int = DEEP) -> DataFrame:
    """Of every row doc_id, th (text hash), fp (wide SimHash), n (distinct shingle hashes), least (the ``size`` least of these) and node (a hash of the three)."""

    def run(batch):
        fps, n, least = [], [], []
        for t in common.utf8(batch):
            known = np.unique(np.fromiter(shingle_hashes(t, n_words), np.uint64))
            fps.append(wide_fingerprint(known).tobytes())
            n.append(len(known))
            least.append(known[:size].view(np.int64) if len(known) else np.zeros(1, np.int64))
        return {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "fp": fps, "n": n, "least": pa.array(least, pa.list_(pa.int64()))}

    src = common.id_and_text(docs).select("doc_id", F.xxhash64("text").alias("th"), "text")
    out = common.map_arrow(src, run, "doc_id long, th long, fp binary, n long, least array<long>")
    return out.withColumn("node", F.xxhash64("fp", "n", "least"))


def _references(key: np.ndarray, fps: np.ndarray, n: int = N_REFERENCES) -> np.ndarray:
    """Pivot distance table whose pivots are the first rows of each row's own bucket.

    At this radius random pivots tell nothing apart; a pivot from the bucket
    tells its own near copies from all others.
    """
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    return np.stack([_distance(fps, fps[np.repeat(first + np.minimum(p, size - 1), size)]) for p in range(n)])


def _cover(fps: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a large bucket that join all that its linked pairs join, without spelling the pairs out.

    Leaders first: each row is compared with every leader, and a row near no
    leader leads. That leaves out links between two rows which both follow
    other rows; these matter only across components. So the followers outside
    the component that has most of them are compared with all rows, too, after
    the pivot table of the first leaders' distances has discarded what it can.
    """
    n, lane = len(fps), fps[:, 0].copy()
    a, b, free = [], [], np.ones(n, bool)

    def near(i: int, rows: np.ndarray) -> np.ndarray:
        rows = rows[np.minimum(sizes[rows], sizes[i]) >= SIZE_RATIO * np.maximum(sizes[rows], sizes[i])]
        small = np.minimum(sizes[rows], sizes[i]) <= SMALL
        rows = rows[small | (np.bitwise_count(lane[rows] ^ lane[i]) <= LANE_RADIUS)]
        small = np.minimum(sizes[rows], sizes[i]) <= SMALL
        rows = rows[small | (_distance(fps[rows], fps[i]) <= radius)]
        a.append(np.full(len(rows), i))
        b.append(rows)
        return rows

    every, table, leads = np.arange(n), [], np.zeros(n, bool)
    for i in range(n):
        if free[i]:
            free[near(i, every)] = False
            leads[i] = True
            if len(table) < N_PIVOTS:
                table.append(_distance(fps, fps[i]))
    lab = _forest(n, np.concatenate(a), np.concatenate(b))
    follows = np.flatnonzero(~leads)
    if len(follows):
        names, count = np.unique(lab[follows], return_counts=True)
        for i in follows[lab[follows] != names[np.argmax(count)]]:
            rows = every
            for d in table:
                rows = rows[(np.minimum(sizes[rows], sizes[i]) <= SMALL) | (np.abs(d[rows] - d[i]) <= radius)]
            near(i, rows)
    return np.concatenate(a), np.concatenate(b)


def _alike(sets: list[np.ndarray]) -> list[int]:
    """Of each set the first one that links reach; sets alike to 0.8 or more are linked, by exact count.

    Each set that is reached is compared with all that are not, so a group of
    copies costs few comparisons.
    """
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array(list(map(len, sets)))
    edge = np.cumsum([0, *size])
    bears = np.zeros(len(ids) and int(ids.max()) + 1, bool)
    root, left = [-1] * len(sets), np.arange(len(sets))
    while len(left):
        first, left = int(left[0]), left[1:]
        root[first], todo = first, [first]
        flat = np.concatenate([ids[edge[x] : edge[x + 1]] for x in left]) if len(left) else ids[:0]
        while todo and len(left):
            i = todo.pop()
            bears[ids[edge[i] : edge[i + 1]]] = True
            common_ = np.add.reduceat(bears[flat], np.cumsum([0, *size[left][:-1]]), dtype=np.int64)
            bears[ids[edge[i] : edge[i + 1]]] = False
            near = 9 * common_ >= 4 * (size[i] + size[left])  # common / union >= 4 / 5
            for x in left[near].tolist():
                root[x] = first
                todo.append(x)
            if near.any():
                flat = flat[np.repeat(~near, size[left])]
                left = left[~near]
    return root


def _verified(docs: DataFrame, members: DataFrame, n_words: int) -> DataFrame:
    """node and root of exact classes. ``members``: candidate class (group), node, and doc_id and th of a row that has its text."""
    texts = common.id_and_text(docs).withColumn("th", F.xxhash64("text")).withColumnsRenamed({"doc_id": "own_id", "th": "own_th"})
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_th") == F.col("th"))
    found = texts.join(members, same).select("group", "node", "text")

    def run(batches):
        rows = (
            row
            for batch in batches
            for i in range(0, batch.num_rows, 256)
            for part in [batch.slice(i, 256)]
            for row in zip(part.column("group").to_pylist(), part.column("node").to_pylist(), common.utf8(part), strict=True)
        )
        for _, group in groupby(rows, lambda r: r[0]):
            sets = {}
            for _, node, text in group:
                if node not in sets:  # rows alike in id and text
                    sets[node] = np.unique(np.fromiter(shingle_hashes(text, n_words), np.uint64))
            nodes = list(sets)
            root = [nodes[x] for x in _alike(list(sets.values()))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(root, pa.int64())], names=["node", "root"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n, "group").sortWithinPartitions("group", "node").mapInArrow(run, "node long, root long")


def copy_classes(docs: DataFrame, n_words: int = SHINGLE, radius: int = COPY_RADIUS, hot: int = HOT) -> DataFrame:
    """doc_id, th and component_id of near copies: sets of word shingles alike to 0.8 or more, by exact count.

    At that likeness SimHashes of 64 bits differ in 4 to 18 bits, which neither
    can be cut into blocks nor tells 0.8 from 0.6; 2,048 bits tell the likeness
    to 0.02 (one standard deviation), and sets of sizes too far apart are
    discarded for certain. Texts whose shingle sets are alike to 0.8 share one
    of their 8 least shingle hashes but for 3 cases in a million, so these are
    the buckets; in a bucket the pivot table discards pairs and the survivors'
    fingerprints are compared, with SLACK bits to spare; pairs with a set of
    SMALL shingles or fewer all pass. What these links join is a candidate
    class, in which the shingle sets themselves decide. A hash that more than
    ``hot`` texts bear makes buckets with each of the DEEP least hashes of its
    bearers; a pair alike to 0.8 that shares such hashes only lacks a second
    one in one case of a billion, so what is found does not hang on how many
    bear a hash. Texts without words are alike.

    Rows alike in id and text count as one document; rows without id have a
    component_id only if a row of their class has an id; a null text counts as
    empty; an empty table gives an empty one; other columns are not looked at.
    """
    rows = common.materialize(sketches(docs, n_words), "sketches")
    wanted = ["node", "fp", "n"]
    nodes = rows.groupBy(*wanted, "least").agg(F.min("doc_id").alias("least_id"))
    by_hash = F.posexplode(F.slice("least", 1, SKETCH)).alias("place", "k")
    keyed = nodes.select(*wanted, "least", by_hash)
    shared = nodes.select(by_hash).groupBy("k").agg(F.count("*").alias("bearers")).where("bearers > 1")
    others = F.expr("slice(least, place + 2, size(least))")  # those after k; with one before it, that one's bucket has the pair
    kept = keyed.join(shared, "k").select(F.lit(0).cast("long").alias("m"), "k", *wanted, "bearers", F.when(F.col("bearers") > hot, others).alias("others"))
    kept = common.materialize(kept, "copies")

    def links_in(buckets: DataFrame) -> DataFrame:
        def find(key, cols):
            fps, sizes = cols["fp"], cols["n"]
            lane = fps[:, 0].copy()

            def sure(a, b):
                return np.minimum(sizes[a], sizes[b]) <= SMALL

            def may(a, b):
                alike = np.minimum(sizes[a], sizes[b]) >= SIZE_RATIO * np.maximum(sizes[a], sizes[b])
                return alike & (sure(a, b) | (np.bitwise_count(lane[a] ^ lane[b]) <= LANE_RADIUS))

            slack = radius + SLACK
            at, root = _bucket_links(key, fps, slack, hot, lambda s, m: _cover(fps[s : s + m], sizes[s : s + m], slack), _references(key, fps), may, sure)
            return cols["node"][at], cols["node"][root]

        return _by_bucket(buckets, ("m", "k"), find)

    pairs = links_in(kept.where(F.col("bearers") <= hot).select("m", "k", *wanted))
    large = kept.where(F.col("bearers") > hot)
    finer = large.select(F.col("k").alias("m"), F.explode("others").alias("k"), *wanted)
    pairs = pairs.unionByName(links_in(finer))
    reach = common.materialize(graph.components(pairs), "candidates")
    grouped = reach.select(F.col("a").alias("node"), F.col("root").alias("group")).unionByName(reach.select(F.col("root").alias("node"), F.col("root").alias("group")).distinct())
    bearer = rows.join(grouped, "node").groupBy("group", "node").agg(F.min(F.struct("doc_id", "th")).alias("row"))
    exact = _verified(docs, bearer.select("group", "node", "row.doc_id", "row.th"), n_words)
    rooted = nodes.select("node", "least_id").join(exact, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    rooted = common.materialize(rooted, "rooted")
    of_root = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_row = rooted.join(of_root, "root").select("node", "component_id")
    return rows.select("doc_id", "th", "node").join(of_row, "node", "left").select("doc_id", "th", "component_id")


def keep_one(docs: DataFrame, n_words: int = SHINGLE, radius: int = COPY_RADIUS) -> DataFrame:
    """All columns of the rows of ``docs`` that stay: of each group of near copies the one with the least id.

    Rows alike in id and text count as one. Rows without ids stay only if no
    row of the group has an id, one for each text.
    """
    kept = copy_classes(docs, n_words, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "th").distinct()
    return common.with_facts(docs, kept).dropDuplicates(["own_id", "own_th"]).select("row.*")
