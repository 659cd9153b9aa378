"""Substring dedup by sliding sentence spans.

A text is cut into units: sentences with the blanks that follow, and in
sentences of over WINDOW words also before each word that has the least hash in
some WINDOW consecutive words of its sentence. Such a cut depends on the words
around it alone, and no unit has more than WINDOW words. A span starts at each
unit and is the shortest run with at least MIN_UNITS units and MIN_WORDS words:
of whole sentences where a sentence starts (of units in sentences of over LONG
words), of any units inside a sentence. Any 50 words with the same line breaks
that two texts share hold a whole span of both, wherever they stand.
Spans are hashed and joined over all documents; units covered by any span that
is not the first of its kind, in the order of (doc_id, text hash, place), go.
"""

from __future__ import annotations

import re
from itertools import accumulate, chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from . import common

MIN_UNITS = 2
MIN_WORDS = 12
LONG = 32
WINDOW = 9
_SENTENCE = re.compile(rb"[^.!?\n]*(?:[.!?]+(?=\s|$)|[.!?]+|\n|$)\s*")
_END = re.compile(rb"[.!?\n]")
_WORD = re.compile(rb"\s*\S+\s*")


def _cuts(sentences: list[list[bytes]]) -> list[list[int]]:
    """Of each sentence the places of the words that are the least by hash (the first, if alike) in a window."""
    size = list(map(len, sentences))
    h = np.fromiter(map(crc32, chain.from_iterable(sentences)), np.uint32, sum(size)) * np.uint32(2654435761)
    of = np.repeat(np.arange(len(size)), size)
    start = np.flatnonzero(of[: 1 - WINDOW] == of[WINDOW - 1 :])  # windows do not go beyond a sentence
    least = np.zeros(len(h), bool)
    least[start + np.lib.stride_tricks.sliding_window_view(h, WINDOW)[start].argmin(axis=1)] = True
    edge = np.cumsum([0, *size])
    least[edge[:-1]] = False
    at = np.flatnonzero(least)
    return [(x - e).tolist() for x, e in zip(np.split(at, np.searchsorted(at, edge[1:-1])), edge, strict=False)]


def units(text: bytes) -> list[bytes]:
    """The units of a UTF-8 text; joined they are the text."""
    out = [u for u in _SENTENCE.findall(text) if u]
    split = {k: w for k, u in enumerate(out) if len(u) > 2 * WINDOW and len(w := u.lower().split()) > WINDOW}
    if not split:
        return out
    whole, out, at = out, [], 0
    for (k, _), cuts in zip(split.items(), _cuts(list(split.values())), strict=True):
        out += whole[at:k]
        pieces = _WORD.findall(whole[k])
        out += [b"".join(pieces[i:j]) for i, j in zip([0, *cuts], [*cuts, len(pieces)], strict=True)]
        at = k + 1
    return out + whole[at:]


def spans(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """(hash as signed long, end) of the span that starts at each unit; the list ends where no span fits."""
    words = [u.lower().split() for u in parts]
    digests = list(map(xxh64_digest, map(b" ".join, words)))
    upto = list(accumulate(map(len, words), initial=0))
    n = len(parts)
    starts, borders, s = {}, [], 0  # place among the borders of each sentence start
    for k, u in enumerate(parts, 1):
        if k == n or _END.search(u):
            starts[s] = len(borders)
            borders += range(s + 1, k + 1) if upto[k] - upto[s] > LONG else [k]
            s = k
    hashes, ends, j, c = [], [], 0, 0
    for i in range(n):
        j = max(j, i + MIN_UNITS)
        while j <= n and upto[j] - upto[i] < MIN_WORDS:
            j += 1
        if j > n:
            break
        end = j
        if i in starts:
            c = max(c, starts[i] + MIN_UNITS - 1)
            while c < len(borders) and upto[borders[c]] - upto[i] < MIN_WORDS:
                c += 1
            if c < len(borders):
                end = borders[c]
        ends.append(end)
    for h in map(xxh64_intdigest, (b"".join(digests[i:j]) for i, j in enumerate(ends)), repeat(42)):
        hashes.append(h - (1 << 64) if h >> 63 else h)
    return hashes, ends


def _spans_of(src: DataFrame) -> DataFrame:
    """h (span hash), doc_id, th (text hash), at: the first place of each span in each document."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                h, of, at = [], [], []
                for k, t in enumerate(common.utf8(part)):
                    first: dict[int, int] = {}
                    for place, x in enumerate(spans(units(t))[0]):
                        first.setdefault(x, place)
                    h += first.keys()
                    at += first.values()
                    of += [k] * len(first)
                take = pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), part.column("doc_id").take(take), part.column("th").take(take), pa.array(at, pa.int32())], names=["h", "doc_id", "th", "at"])

    return src.select("doc_id", "th", "text").mapInArrow(run, "h long, doc_id long, th long, at int")


def _removed(text: bytes, later: list[int]) -> tuple[list[bytes], list[bool]]:
    """Units, and whether each goes: ``later`` are the starts of spans that are not first by the join."""
    parts = units(text)
    hashes, ends = spans(parts)
    gone = [False] * len(parts)
    seen: set[int] = set()
    starts = set(later)
    for i, (h, j) in enumerate(zip(hashes, ends, strict=True)):
        if i in starts or h in seen:
            for k in range(j - 1, i - 1, -1):
                gone[k] = True
        seen.add(h)
    return parts, gone


def later_spans(docs: DataFrame) -> DataFrame:
    """doc_id, th, starts: places of the spans that an earlier document has. ``docs``: doc_id, th, text."""
    every = common.materialize(_spans_of(docs), "spans")
    shared = every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    found = common.materialize(every.join(shared, "h"), "shared")  # most spans have no equal: only their hashes are counted
    common.drop(every)
    first = found.groupBy("h").agg(F.min(F.struct("doc_id", "th", "at")).alias("f"), F.count("*").alias("n")).where("n > 1").select("h", "f")
    joined = found.join(first, "h")
    later = joined.where(~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("th") == F.col("f.th"))))
    return later.groupBy("doc_id", "th").agg(F.collect_set("at").alias("starts"))


def dedup(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as a struct (row) with the repeated units taken out of its text, n_units and n_removed.

    Null texts stay null; rows alike in id and text count as one document;
    texts without a span stay as they are; other columns are kept.
    """
    src = common.id_and_text(docs).withColumn("th", F.xxhash64("text"))
    joined = common.with_facts(docs, later_spans(src), "left").select("row", "starts")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                row, starts = batch.column(0).slice(i, 256), batch.column(1).slice(i, 256)
                fields = row.flatten()
                texts, n, removed = [], [], []
                raw = common.utf8(pa.RecordBatch.from_arrays([fields[at]], names=["text"]))
                for t, null, later in zip(raw, fields[at].is_null().to_pylist(), starts.to_pylist(), strict=True):
                    parts, gone = _removed(t, later or [])
                    kept = b"".join(u for u, g in zip(parts, gone, strict=True) if not g) if any(gone) else t
                    texts.append(None if null else kept.decode())
                    n.append(len(parts))
                    removed.append(sum(gone))
                fields[at] = pa.array(texts, fields[at].type)
                out = pa.StructArray.from_arrays(fields, fields=list(row.type))
                yield pa.RecordBatch.from_arrays([out, pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names=["row", "n_units", "n_removed"])

    return joined.mapInArrow(run, f"row {joined.schema['row'].dataType.simpleString()}, n_units long, n_removed long")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``dedup`` as a filter: the columns of ``docs``, with n_chars (if there) made right; rows of which nothing is left go."""
    left = dedup(docs).where("n_removed = 0 or n_removed < n_units").select("row.*")
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left
