"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed byte n-gram of a word with a blank at
either end (A-Z lower-cased). Each feature is scaled by the log ratio of its smoothed document
frequencies in the two classes, and a ridge logistic regression is fitted on
the scaled features (L-BFGS on the driver, over a bounded labelled sample). The
product of ratio and weight is one table, so scoring a text is a sum over its
distinct n-grams.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .quality import chosen, fold, labelled

BITS = 20
SIZES = (4, 5, 6, 7)
MAX_PER_CLASS = 3_000
_MULT = [0x9E3779B1 * pow(0x85EBCA77, k, 1 << 32) % (1 << 32) for k in range(16)]  # odd 32-bit multipliers
_BLOCK = 1 << 20


class Grams:
    """The distinct hashed n-grams of a text, without sorting: a table remembers who wrote last."""

    def __init__(self, sizes: tuple[int, ...] = SIZES, bits: int = BITS):
        self.sizes, self.bits = sizes, bits
        self.last = np.zeros(1 << bits, np.int64)

    def distinct(self, ids: np.ndarray) -> np.ndarray:
        order = np.arange(len(ids))
        self.last[ids] = order
        return ids[self.last[ids] == order]

    def ids(self, text: bytes) -> np.ndarray:
        clean = b" " + b" ".join(text.lower().split()) + b" "
        parts = []
        for at in range(0, max(1, len(clean) - 2), _BLOCK):
            b = np.frombuffer(clean, np.uint8)[at : at + _BLOCK + max(self.sizes) - 1].astype(np.uint32)
            h = b * np.uint32(_MULT[0])
            blanks = np.cumsum(b == 32)
            for n in range(2, max(self.sizes) + 1):
                if len(b) < n:
                    break
                h = h[: len(b) - n + 1] + b[n - 1 :] * np.uint32(_MULT[n - 1])
                if n in self.sizes:
                    mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
                    inner = blanks[n - 2 : len(b) - 1] == blanks[: len(b) - n + 1]  # no blank but at its ends
                    parts.append(self.distinct(mixed[inner] >> np.uint32(32 - self.bits)))
        return self.distinct(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def _minimize(f, w: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` returns value and gradient."""
    value, grad = f(w)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        d, a = -grad, []
        for s, y, r in reversed(pairs):
            a.append(r * (s @ d))
            d = d - a[-1] * y
        if pairs:
            s, y, r = pairs[-1]
            d = d / (r * (y @ y))
        for (s, y, r), x in zip(pairs, reversed(a), strict=True):
            d = d + s * (x - r * (y @ d))
        slope, step = grad @ d, 1.0 if pairs else 1.0 / max(1.0, np.abs(grad).sum())
        while True:
            new = w + step * d
            new_value, new_grad = f(new)
            if new_value <= value + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = new - w, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory :], (s, y, 1 / (s @ y))]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        w, value, grad = new, new_value, new_grad
        if done:
            break
    return w


@dataclass
class Sample:
    """Labelled documents: y and weight of each, and the distinct n-grams it has among ``used``.

    ``seen`` counts, by class and used n-gram, the documents of the whole
    sample. The weights undo the sampling: they sum to the class's size.
    """

    y: np.ndarray
    weight: np.ndarray
    used: np.ndarray  # hashed n-grams
    seen: np.ndarray  # class x used
    cols: np.ndarray  # places in used, document after document
    ends: np.ndarray  # where each document's end


def log_ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, least_docs: int = 3, least_ratio: float = 1.0) -> np.ndarray:
    """Log ratios of the smoothed document frequencies; 0 where they say little about the class."""
    ratio = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
    ratio[(pos + neg < least_docs) | (np.abs(ratio) <= least_ratio)] = 0
    return ratio


_STEP = 1 << 19  # n-grams looked at together


def fit(sample: Sample, target: int, bits: int = BITS, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """(weights by hashed n-gram, bias) that tell class ``target`` from the others.

    Without both classes the weights are zero and the bias is the smoothed log
    odds.
    """
    y, weight, n = (sample.y == target).astype(float), sample.weight, len(sample.y)
    total = weight.sum()
    zero = np.zeros(1 << bits, np.float32), float(np.log((weight @ y + 0.5) / (total - weight @ y + 0.5))) if n else 0.0
    if not n or not 0 < y.sum() < n:
        return zero
    pos, neg = sample.seen[target], sample.seen.sum(axis=0) - sample.seen[target]
    ratio = log_ratios(pos, neg, int(y.sum()), int(n - y.sum()))
    if not ratio.any():
        return zero
    scale = weight * n / total
    sizes = np.diff(np.r_[0, sample.ends])
    # whole documents of about _STEP n-grams together: nothing as long as all of them is made
    cuts = [0, *(np.flatnonzero(np.diff((sample.ends - 1) // _STEP)) + 1).tolist(), n]
    blocks = [(a, b, int(sample.ends[a] - sizes[a]), int(sample.ends[b - 1])) for a, b in itertools.pairwise(cuts) if b > a]

    def loss(w):
        v, z = ratio * w[:-1], np.full(n, w[-1])
        for a, b, s, e in blocks:
            z[a:b] += np.bincount(np.repeat(np.arange(b - a), sizes[a:b]), weights=v[sample.cols[s:e]], minlength=b - a)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        value = scale @ (np.logaddexp(0, z) - y * z) + ridge / 2 * (w[:-1] @ w[:-1])
        error, grad = scale * (p - y), np.zeros(len(ratio))
        for a, b, s, e in blocks:
            grad += np.bincount(sample.cols[s:e], weights=np.repeat(error[a:b], sizes[a:b]), minlength=len(ratio))
        return value, np.r_[grad * ratio + ridge * w[:-1], error.sum()]

    w = _minimize(loss, np.r_[np.zeros(len(ratio)), zero[1]])
    out = zero[0]
    out[sample.used] = (w[:-1] * ratio).astype(np.float32)
    return out, float(w[-1])


def sample(docs: DataFrame, truth: DataFrame, sizes: tuple[int, ...], bits: int, max_per_class: int, n_classes: int = 2) -> Sample:
    """At most ``max_per_class`` documents of each class (y: 0 .. n_classes - 1), chosen by a hash of the id.

    Two passes over the sample's n-grams, which are in a table: one returns the
    documents of each class by hashed n-gram (2**bits rows at most), the other
    only those n-grams of each document that tell some class from the rest.
    """
    rows, counts = chosen(truth, max_per_class)
    src = common.id_and_text(docs).join(F.broadcast(rows), "doc_id").select("doc_id", "y", "text")

    def grams_of(batch):
        grams = Grams(sizes, bits)
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "ids": pa.array([grams.ids(t).astype("<u4").tobytes() for t in common.utf8(batch)], pa.binary())}

    table = common.map_arrow(src, grams_of, "doc_id long, y int, ids binary").dropDuplicates(["doc_id"])
    table = common.materialize(table, "grams")
    names = [f"c{d}" for d in range(n_classes)]

    def count(batches):
        seen = np.zeros((n_classes, 1 << bits), np.int32)
        for batch in batches:
            for y, ids in zip(batch.column("y").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                seen[y][np.frombuffer(ids, "<u4")] += 1  # a document's ids are distinct
        some = np.flatnonzero(seen.any(axis=0))
        for i in range(0, len(some), 1 << 16):
            part = some[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(s[part], pa.int32()) for s in seen)], names=["id", *names])

    found = table.select("y", "ids").mapInArrow(count, "id int, " + ", ".join(f"{c} int" for c in names))
    found = found.groupBy("id").agg(*[F.sum(c).cast("int").alias(c) for c in names]).where(" + ".join(names) + " >= 3").toArrow()  # 2**bits rows at most
    order = np.argsort(found.column("id").to_numpy())
    used, seen = found.column("id").to_numpy()[order], np.stack([found.column(c).to_numpy()[order].astype(np.int64) for c in names])
    del found
    in_sample = {r["y"]: r["n"] for r in table.groupBy("y").agg(F.count("*").alias("n")).collect()}
    size = np.array([in_sample.get(d, 0) for d in range(n_classes)])
    tells = np.zeros(len(used), bool)
    for d in range(n_classes):
        if 0 < size[d] < size.sum():
            tells |= log_ratios(seen[d], seen.sum(axis=0) - seen[d], size[d], size.sum() - size[d]) != 0
    used, seen = used[tells], seen[:, tells]
    known = np.zeros(1 << bits, bool)
    known[used] = True
    packed = np.packbits(known).tobytes()

    def keep(batch):
        place = np.cumsum(np.unpackbits(np.frombuffer(packed, np.uint8)), dtype=np.int32) - 1
        some = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        cols = []
        for ids in batch.column("ids").to_pylist():
            x = np.frombuffer(ids, "<u4")
            cols.append(np.sort(place[x[some[x]]]).astype("<u4").tobytes())
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "cols": pa.array(cols, pa.binary())}

    got = common.map_arrow(table, keep, "doc_id long, y int, cols binary").toArrow()
    common.drop(table)
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    y = got.column("y").to_numpy()[order]
    blobs = [got.column("cols")[int(i)].as_buffer() for i in order]
    cols = np.frombuffer(b"".join(blobs), "<u4")
    ends = np.cumsum([len(b) // 4 for b in blobs], dtype=np.int64)
    weight = np.array([counts[c] / in_sample[c] for c in y.tolist()], np.float64)
    return Sample(y, weight, used, seen, cols, ends)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: trained on the labelled ids outside fold 2 of 4, applied to every whole text.

    Null and empty texts are scored by what is left of them (no n-grams: the
    bias and the n-grams of blanks); without labels every score is 0.5.
    """
    truth = labelled(labels, "toxic").where(fold(F.col("doc_id"), 4) != 2)
    shared = docs.sparkSession.sparkContext.broadcast(fit(sample(docs, truth, SIZES, BITS, MAX_PER_CLASS), 1))  # 2**BITS numbers
    common.release()

    def run(batch):
        table, bias = shared.value
        grams = Grams()
        z = np.array([bias + float(table[grams.ids(t)].sum()) for t in common.utf8(batch)])
        return {"doc_id": batch.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))}

    scored = common.map_arrow(common.id_and_text(docs, id_col, text_col), run, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
