"""Byte-level BPE: encoding with Spark higher-order functions, decoding by concatenation.

The ranks become a literal rank map: an array of small maps, indexed by a hash
of the piece, made from one JSON literal that Catalyst folds into a constant
(a lookup in one large map literal would scan its 50,000 keys).

One stage does all, without a shuffle, a broadcast or a driver's hand:

1. ``words``: each text is cut by the pattern; a task sends every word that is
   new to it as a row of its own, ahead of the documents that use it, and of
   each document the places of its words in the task's list.
2. Spark's higher-order functions encode each such word: a fold over the word's
   borders merges the adjacent pair of least rank until none has one. The same
   projection decodes the ids again, by concatenating the pieces they stand for.
3. ``documents``: ids and decoded bytes of each document's words, side by side.

A task's list holds WORDS_HELD words; then it begins anew. Words of over
FOLD_BYTES bytes, which the fold would take seconds for, are merged by a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 15
WORDS_HELD = 400_000  # of a task, at once
FOLD_BYTES = 512
_NONE = 1 << 51  # above all ranks, which are shifted by _PLACE
_PLACE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a tiktoken file (on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# ---------------------------------------------------------------- higher-order functions


def _bucket(piece: Column) -> Column:
    return F.crc32(piece).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _no_ids() -> Column:
    return F.array().cast("array<int>")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once: a one-element array carries it."""
    return F.get(F.transform(F.array(value), use), 0)


class RankMap:
    """The rank map as Spark literals: pieces to ranks, and ranks to pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        import zlib

        maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            maps[zlib.crc32(piece) % BUCKETS][piece.hex().upper()] = rank
        self.by_piece = F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")
        pieces = [""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece.hex().upper()
        self.by_rank = F.split(F.lit(",".join(pieces)), ",")

    @staticmethod
    def rank(ranks: Column, piece: Column) -> Column:
        """The rank of a binary piece, or null."""
        return F.get(ranks, _bucket(piece))[F.hex(piece)]

    def encode_word(self, word: Column) -> Column:
        """array<int> of a binary word's ids: the whole word if it has a rank, else the fold. Empty words have none.

        A step costs the word's bytes; use it on distinct words. The rank map
        stands in the plan once, as the plan's description would be some 20 MB
        otherwise.
        """
        return _once(F.struct(word.alias("word"), self.by_piece.alias("ranks")), lambda b: self._encode(b["word"], b["ranks"]))

    def _encode(self, word: Column, ranks: Column) -> Column:
        n = F.octet_length(word)

        def rank_of(start: Column, stop: Column) -> Column:
            piece = F.substring(word, start + 1, stop - start)
            return F.coalesce(self.rank(ranks, piece).cast("long") * _PLACE, F.lit(_NONE))

        def start_of(entry: Column) -> Column:
            return entry.bitwiseAND(F.lit(_PLACE - 1)).cast("int")

        # of each piece its start, with the rank it has together with the next one, so that the least is the pair to merge
        borders = F.sequence(F.lit(0), n - 1)
        first = F.transform(borders, lambda i: F.when(i < n - 1, rank_of(i, i + 2)).otherwise(_NONE) + i)

        def merge(state: Column, _: Column) -> Column:
            """Merge the adjacent pair of least rank (the first of equal ones); of the other entries only those beside it change."""

            def merged(least: Column, at: Column) -> Column:
                def stop(k: int) -> Column:
                    return F.coalesce(start_of(F.get(state, at + k)), n)

                def changed(b: Column) -> Column:
                    whole = F.when(b["stop"] < n, rank_of(b["start"], stop(2))).otherwise(_NONE) + b["start"]
                    before = rank_of(start_of(b["left"]), b["stop"]) + start_of(b["left"])
                    return F.transform(b["others"], lambda x: F.when(x == least, whole).when(x == b["left"], before).otherwise(x))

                left, others = F.get(state, at - 2), F.array_remove(state, F.get(state, at))
                return _once(F.struct(left.alias("left"), start_of(least).alias("start"), stop(1).alias("stop"), others.alias("others")), changed)

            def step(least: Column) -> Column:
                at = F.array_position(state, least).cast("int")
                return F.when(least >= _NONE, state).otherwise(_once(at, lambda at: merged(least, at)))

            return _once(F.array_min(state), step)

        def ids(state: Column) -> Column:
            def piece(entry: Column, i: Column) -> Column:
                return F.substring(word, start_of(entry) + 1, F.coalesce(start_of(F.get(state, i + 1)), n) - start_of(entry))

            return F.transform(state, lambda entry, i: self.rank(ranks, piece(entry, i)))

        fold = F.aggregate(F.sequence(F.lit(1), n - 1), first, merge, ids)
        return _once(self.rank(ranks, word), lambda whole: F.when(n == 0, _no_ids()).when(whole.isNotNull(), F.array(whole)).otherwise(fold))

    def decode_ids(self, ids: Column) -> Column:
        """The binary that an array of ids stands for: the pieces, concatenated."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.by_rank, i)), ""))


# ---------------------------------------------------------------- in place


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for short words: a list of the pairs' ranks, of which the two beside each merge change."""
    none, get = 1 << 60, ranks.get
    cuts = list(range(len(word) + 1))
    pairs = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) < none:
        i = pairs.index(best)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(word[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(word[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: merges in the order of rank, then place, kept in a heap; O(n log n)."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n < 64:
        return _merge_short(word, ranks)
    end = list(range(1, n + 1))  # a piece that starts at i ends at end[i]
    before = list(range(-1, n))
    alive = bytearray(b"\x01") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two has changed
        alive[j] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(word[before[i] : stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


# ---------------------------------------------------------------- documents


class _Places(dict):
    """Places of words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def _words(src: DataFrame, ranks: dict[bytes, int], pattern: str, held: int) -> DataFrame:
    """Rows of two kinds, in each partition the words before the documents that use them.

    word, ready (ids, of long words only); or doc_id and at (the words' places
    since the last row with ``anew``, as unsigned 32-bit integers).
    """
    schema = "doc_id long, word binary, ready array<int>, at binary, anew boolean"
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.bool_()]

    def run(batches):
        find, places, anew = regex.compile(pattern).findall, _Places(), True
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                if len(places) >= held:
                    places, anew = _Places(), True
                known, at = len(places), []
                for t in part.column("text").to_pylist():
                    found = find(t)
                    at.append(np.fromiter(map(places.__getitem__, found), "<u4", len(found)).tobytes())
                new = [w.encode() for w in islice(places, known, None)]
                ready = [merge_word(w, ranks) if len(w) > FOLD_BYTES else None for w in new]
                n, m = len(new), len(at)
                cols = ([None] * n + part.column("doc_id").to_pylist(), new + [None] * m, ready + [None] * m, [None] * n + at, [anew] + [False] * (n + m - 1))
                anew = False
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])
        common.release()

    return src.mapInArrow(run, schema)


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ids (array<int>) to a table of binary words."""
    rank_map = RankMap(ranks)
    return words.withColumn("ids", rank_map.encode_word(F.col("word")))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, words_held: int = WORDS_HELD) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit
    ids), decoded_sha256; ``keep_ids`` adds ids and decoded. Null counts as the
    empty text, which has no tokens; repeated rows are each answered; an empty
    table gives an empty one; other columns are not looked at.
    """
    ranks = read_ranks(ranks_path)
    rank_map = RankMap(ranks)
    rows = _words(common.id_and_text(docs, id_col, text_col), ranks, pattern, words_held)
    ids = F.when(F.col("ready").isNotNull(), F.col("ready")).when(F.col("word").isNotNull(), rank_map.encode_word(F.col("word")))
    rows = rows.select("doc_id", "at", "anew", ids.alias("ids"))
    rows = rows.select("*", F.when(F.col("ids").isNotNull(), rank_map.decode_ids(F.col("ids"))).alias("decoded"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]

    def run(batches):
        packed: list[bytes] = []  # of each word, its ids in 4 bytes each
        decoded: list[bytes] = []

        def documents(part):
            out = []
            for i, at in zip(part.column("doc_id").to_pylist(), part.column("at").to_pylist(), strict=True):
                places = np.frombuffer(at, "<u4").tolist()
                row, back = b"".join(map(packed.__getitem__, places)), b"".join(map(decoded.__getitem__, places))
                out.append([i, len(row) // 4, hashlib.sha256(row).hexdigest(), hashlib.sha256(back).hexdigest()] + ([np.frombuffer(row, "<i4"), back] if keep_ids else []))
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=False)], names=names)

        for batch in batches:
            kind = batch.column("at").is_valid().to_numpy(zero_copy_only=False)
            anew = batch.column("anew").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | anew[1:]]).tolist() if len(kind) else []
            for a, b in zip(cuts, [*cuts[1:], len(kind)], strict=True):
                if anew[a]:
                    packed.clear()
                    decoded.clear()
                part = batch.slice(a, b - a)
                if kind[a]:
                    for k in range(0, b - a, 256):
                        yield documents(part.slice(k, 256))
                    continue
                col = part.column("ids")
                flat = col.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
                ends = (4 * np.cumsum(np.diff(col.offsets.to_numpy()))).tolist()
                packed += [flat[x:y] for x, y in zip([0, *ends], ends, strict=False)]
                decoded += part.column("decoded").to_pylist()
        common.release()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if keep_ids else "")
    return rows.mapInArrow(run, schema)
