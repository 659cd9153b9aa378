"""Exact substring dedup by external induced suffix sorting.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else.

* Sharding: every string of LENGTH bytes has the key "least hash among its
  Q-byte strings", which depends on the string alone. Neighbouring strings
  mostly share a key; a segment is a run of them with the bytes they cover.
  Equal strings have equal keys, so only segments whose key occurs in another
  segment (or whose Q-byte string occurs in them twice) matter, and all that
  matter for each other share a shard.
* Equal segments are counted before anything is sorted: their strings all
  repeat. One of them goes on, to be compared with segments that differ.
* Each shard's segments are sorted as suffixes with common prefixes (see
  induced.py); strings whose neighbour in that order shares LENGTH bytes repeat.
* Covered bytes are put together per distinct text. Texts that occur more than
  once repeat as a whole, if they have LENGTH bytes.

Texts travel as zstd frames. Texts are known by a 128-bit hash, segments by 128
bits more than their key.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .induced import Sorter

LENGTH = 200
Q = 32  # a power of two
SHARD_BYTES = 3 << 20  # a shard's segments are sorted in groups of whole keys of about this many bytes
MAX_TUPLES = 1 << 19  # that a queue holds in memory: the rest of a shard's millions is on disk
_BLOCK = 1 << 20


def _q_hashes(b: np.ndarray) -> np.ndarray:
    """Hash (uint64) of every Q-byte string, by doubling."""
    h, n, a = b.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while n < Q:
        h = h[:-n] * np.uint64(a) + h[n:]
        a = a * a % (1 << 64)
        n *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours: prefix and suffix minima of blocks of w."""
    x = np.concatenate([h, np.full(-len(h) % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - w + 1
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, last start, twice) of the runs of strings that share a key.

    ``twice``: the key's Q-byte string occurs more than once in the segment. Long
    texts are cut into blocks of starts; that only cuts segments.
    """
    b = np.frombuffer(text, np.uint8)
    w = length - Q + 1
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(b) - length + 1, _BLOCK):
        h = _q_hashes(b[at : at + _BLOCK + length - 1])
        m = _window_min(h, w)
        lo = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        hi = np.r_[lo[1:] - 1, len(m) - 1]
        key = m[lo]
        # places of minima: h is the greatest of the minima of the windows over it
        top = ~_window_min(~np.r_[np.zeros(w - 1, np.uint64), m, np.zeros(w - 1, np.uint64)], w)
        place = np.flatnonzero(h == top)
        value, n = h[place], np.zeros(len(lo), np.int64)
        k, live = np.searchsorted(place, lo), np.arange(len(lo))
        while len(live):
            live = live[(k[live] < len(place)) & (n[live] < 2)]
            live = live[place[k[live]] <= hi[live] + w - 1]
            n[live] += value[k[live]] == key[live]
            k[live] += 1
        out.append((key.view(np.int64), lo + at, hi + at, n > 1))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _repeated_in(parts: list[bytes], length: int, folder: str, max_tuples: int) -> list[np.ndarray]:
    """For each segment, which of its strings start elsewhere in these segments."""
    joined = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no 0xff: ends become 0
    flags = Sorter(joined, length, folder, max_tuples).repeated()
    ends = np.cumsum([len(p) + 1 for p in parts])
    return [flags[e - len(p) - 1 : e - length] for e, p in zip(ends, parts, strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _texts(docs: DataFrame, id_col: str, text_col: str, length: int, keys_only: bool) -> DataFrame:
    """Per row: doc_id, key, n_bytes, whole sha256; or per row: key, z (zstd frame of the text)."""

    def facts(batch):
        raw = common.utf8(batch)
        return {
            "doc_id": batch.column("doc_id"),
            "key": pa.array([xxhash.xxh3_128_digest(t) for t in raw], pa.binary()),
            "n_bytes": pa.array([len(t) for t in raw], pa.int64()),
            "whole": pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
        }

    def frames(batch):
        pack = zstandard.ZstdCompressor(level=1).compress
        raw = [t for t in common.utf8(batch) if len(t) >= length]
        return {"key": pa.array([xxhash.xxh3_128_digest(t) for t in raw], pa.binary()), "z": pa.array([pack(t) for t in raw], pa.binary())}

    src = common.id_and_text(docs, id_col, text_col)
    if keys_only:
        return common.map_arrow(src, facts, "doc_id long, key binary, n_bytes long, whole string")
    return common.map_arrow(src.select("text"), frames, "key binary, z binary")


def _anchors(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """a (segment key), key (text), lo, hi, twice: the segments of every row."""

    def run(batch):
        cols: list[list] = [[], [], [], []]
        keys, of = [], []
        for t in common.utf8(batch):
            if len(t) < length:
                continue
            found = segments(t, length)
            keys.append(xxhash.xxh3_128_digest(t))
            of.append(len(found[0]))
            for c, v in zip(cols, found, strict=True):
                c.append(v)
        a, lo, hi, twice = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
        key = pa.array(keys, pa.binary()).take(pa.array(np.repeat(np.arange(len(of)), of)))
        return {"a": pa.array(a, pa.int64()), "key": key, "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()), "twice": pa.array(twice.astype(bool))}

    src = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return common.map_arrow(src, run, "a long, key binary, lo long, hi long, twice boolean")


def repeated_intervals(docs: DataFrame, text_col: str = "text", length: int = LENGTH, max_tuples: int = MAX_TUPLES) -> DataFrame:
    """key, s, e: byte intervals [s, e) of each distinct text that repeated strings cover (not merged).

    Copies of a text count once here.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = common.materialize(_anchors(docs, text_col, length), "anchors")
    where = F.struct("key", "lo")
    shared = found.groupBy("a").agg(F.min(where).alias("x"), F.max(where).alias("y"), F.max("twice").alias("t")).where("x <> y or t").select("a")
    segs = found.join(shared, "a").groupBy("key", "a", "lo").agg(F.max("hi").alias("hi"), F.max("twice").alias("twice"))
    wanted = segs.groupBy("key").agg(F.collect_list(F.struct("a", "lo", "hi", "twice")).alias("segs"))  # bounded by the text
    wanted = common.materialize(wanted, "wanted")
    frames = _texts(docs, "doc_id" if "doc_id" in docs.columns else docs.columns[0], text_col, length, keys_only=False)
    frames = frames.groupBy("key").agg(F.first("z").alias("z"))  # copies of a text meet before the shuffle

    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                rows = []
                for key, z, segs_of in zip(part.column("key").to_pylist(), part.column("z").to_pylist(), part.column("segs").to_pylist(), strict=True):
                    t = zstandard.ZstdDecompressor().decompress(z)
                    for g in segs_of:
                        piece = t[g["lo"] : g["hi"] + length]
                        rows.append((g["a"], xxhash.xxh3_128_digest(piece), key, g["lo"], g["hi"], g["twice"], piece))
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["a", "s", "key", "lo", "hi", "twice", "piece"])
        common.release()

    pieces = frames.join(wanted, "key").select("key", "z", "segs").mapInArrow(cut, "a long, s binary, key binary, lo long, hi long, twice boolean, piece binary")
    pieces = common.materialize(pieces, "pieces")
    kinds = pieces.groupBy("a", "s").agg(F.min(where).alias("x"), F.max(where).alias("y"), F.max("twice").alias("twice"), F.first("piece").alias("piece"))
    kinds = kinds.select("a", "s", F.col("x.key").alias("key"), F.col("x.lo").alias("lo"), (F.col("x") != F.col("y")).alias("many"), "twice", "piece")
    kinds = common.materialize(kinds, "kinds")

    def sort(batches):
        def out(rows):
            res: list[tuple] = []
            with tempfile.TemporaryDirectory() as folder:
                for (_, key, lo, many, _, _), flags in zip(rows, _repeated_in([r[5] for r in rows], length, folder, max_tuples), strict=True):
                    if not many:
                        for s, e in zip(*_runs(flags), strict=True):
                            res.append((key, lo + int(s), lo + int(e) + length))
            cols = list(zip(*res, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["key", "s", "e"])

        group: list[tuple] = []  # the segments of one key
        shard: list[tuple] = []  # of whole keys
        held = 0

        def close():
            nonlocal held
            if len(group) > 1 or any(r[4] and not r[3] for r in group):
                shard.extend(group)
                held += sum(len(r[5]) for r in group)
            group.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("a", "key", "lo", "many", "twice", "piece")), strict=True):
                if group and group[0][0] != row[0]:
                    close()
                    if held >= SHARD_BYTES:
                        yield out(shard)
                        shard, held = [], 0
                group.append(row)
        close()
        if shard:
            yield out(shard)
        common.release()

    sorted_out = kinds.select("a", "key", "lo", "many", "twice", "piece").repartition(n, "a").sortWithinPartitions("a").mapInArrow(sort, "key binary, s long, e long")
    same = pieces.select("a", "s", "key", "lo", "hi").join(kinds.where("many").select("a", "s"), ["a", "s"])
    return sorted_out.unionByName(same.select("key", F.col("lo").alias("s"), (F.col("hi") + length).alias("e")))


def _merge(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; ``keep_text`` adds the bytes that are left.

    Null counts as empty; equal texts in different rows (repeated rows, too) are
    copies of each other; texts under ``length`` bytes stay whole.
    """
    rows = common.materialize(_texts(docs, id_col, text_col, length, keys_only=True), "texts")
    intervals = repeated_intervals(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), "text", length)
    copies = rows.where(F.col("n_bytes") >= length).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("copied"))
    of_text = intervals.groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("spans"))  # bounded by the text
    single = common.materialize(of_text.join(copies, "key", "left_anti"), "intervals")
    frames = _texts(docs, id_col, text_col, length, keys_only=False)

    def take_out(batch):
        out: dict[str, list] = {k: [] for k in ("key", "n_removed", "n_spans", "kept_sha256", "kept")}
        for key, z, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "z", "spans")), strict=True):
            t, gone = zstandard.ZstdDecompressor().decompress(z), _merge(spans)
            left, at = [], 0
            for s, e in gone:
                left.append(t[at:s])
                at = e
            kept = b"".join([*left, t[at:]])
            for k, v in zip(out, (key, len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if keep_text else None), strict=True):
                out[k].append(v)
        return out

    done = common.map_arrow(frames.join(single, "key").select("key", "z", "spans"), take_out, "key binary, n_removed long, n_spans long, kept_sha256 string, kept binary", rows=64)
    joined = rows.join(copies, "key", "left").join(done if keep_text else done.drop("kept"), "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    out = joined.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        *[F.when(F.col("copied"), F.lit(b"")).otherwise(F.col("kept")).alias("kept")] * keep_text,
    )
    return out
