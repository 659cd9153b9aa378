"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a bounded sample of labelled documents train the trees on the
driver; the trees are flattened into arrays (complete binary trees) that Arrow
batches walk with numpy, all documents of a batch at once.
"""

from __future__ import annotations

from collections import Counter
from itertools import pairwise
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MAX_TRAIN_ROWS = 20_000
FEATURES = (
    "log_bytes", "log_words", "upper", "lower", "digits", "blank", "newline", "exclaim", "pipe", "stop", "comma", "symbols", "non_ascii",
    "word_length", "longest_word", "short_words", "distinct_words", "repeated_next", "distinct_pairs", "top_word", "shouted", "line_words", "distinct_lines", "stop_spacing",
)
_SYMBOLS = np.array([33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in "!|.," for b in range(256)])


def statistics(text: bytes) -> list[float]:
    """The values of FEATURES for one text; an empty text has zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    return [
        np.log1p(n), np.log1p(len(words)), c[65:91].sum() / n, c[97:123].sum() / n, c[48:58].sum() / n, c[32] / n, c[10] / n, c[33] / n, c[124] / n, c[46] / n, c[44] / n,
        c[_SYMBOLS].sum() / n, c[128:].sum() / n,
        sizes.mean(), min(int(sizes.max()), 1000), (sizes <= 3).mean(), len(seen) / w, sum(map(eq, words, words[1:])) / w, len(set(pairwise(words))) / w,
        max(seen.values(), default=0) / w, c[65:91].sum() / max(1, c[65:91].sum() + c[97:123].sum()), len(words) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)),
        len(words) / (1 + c[46]),
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


class Trees:
    """Flattened trees: feature and threshold of each inner node (heap order), value of each leaf."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.threshold, self.value, self.base = feature, threshold, value, base

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if self.value.size else 0
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - len(f)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, rate: float = 0.12, n_bins: int = 64, least: int = 10, ridge: float = 1.0) -> Trees:
    """Boost logistic loss over feature histograms. No rows: score 0.5; one class: the smoothed share of it."""
    n, m = x.shape
    prior = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(prior / (1 - prior)))
    inner = (1 << depth) - 1
    feature, threshold, value = [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1], method="lower")) for j in range(m)]
        codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
        score = np.full(n, base)
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(depth):
                k = 1 << level
                best = np.full(k, 1e-6)
                cut = np.zeros((k, 2), np.int64)
                for j in range(m):
                    if not len(edges[j]):
                        continue
                    b = len(edges[j]) + 1
                    slot = node * b + codes[j]
                    hist = [np.bincount(slot, weights=w, minlength=k * b).reshape(k, b).cumsum(axis=1) for w in (g, h, np.ones(n))]
                    gl, hl, nl = (a[:, :-1] for a in hist)
                    ga, ha, na = (a[:, -1:] for a in hist)
                    gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                    gain[(nl < least) | (na - nl < least)] = 0
                    top = gain.argmax(axis=1)
                    better = gain[np.arange(k), top] > best
                    best[better] = gain[np.arange(k), top][better]
                    cut[better] = np.stack([np.full(k, j), top], axis=1)[better]
                right = np.zeros(n, bool)
                for i in range(k):
                    if best[i] > 1e-6:
                        at = k - 1 + i
                        f[at], t[at] = cut[i, 0], edges[cut[i, 0]][cut[i, 1]]
                        right |= (node == i) & (codes[cut[i, 0]] > cut[i, 1])
                node = 2 * node + right
            leaves = 1 << depth
            v = -rate * np.bincount(node, weights=g, minlength=leaves) / (np.bincount(node, weights=h, minlength=leaves) + ridge)
            score += v[node]
            feature.append(f)
            threshold.append(t)
            value.append(v)
    k = len(feature)
    return Trees(np.array(feature, np.int64).reshape(k, inner), np.array(threshold).reshape(k, inner), np.array(value).reshape(k, inner + 1), base)


# ---------------------------------------------------------------- labelled tables


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; ids that are null are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """One row per labelled id: doc_id and y (0 or 1). Null ids and labels are left out; of several labels the largest holds."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def chosen(truth: DataFrame, max_rows: int, by_class: bool = True) -> tuple[DataFrame, dict[int, int]]:
    """At most ``max_rows`` rows (doc_id, y) of each class (or of all), those of least id hash; and how many rows each class has.

    A histogram of the hashes tells where to cut, so that no task gets more
    than the few rows around the limit beyond the sample.
    """
    hashed = truth.select("doc_id", "y", F.xxhash64("doc_id").alias("_h"), (F.col("y") if by_class else F.lit(0)).alias("_c"))
    cells = hashed.groupBy(F.col("_c").alias("y"), F.shiftright("_h", 54).alias("cell")).agg(F.count("*").alias("n")).collect()  # 1,024 rows a class
    total, last = {}, {}
    for r in sorted(cells, key=lambda r: (r["y"], r["cell"])):
        if total.get(r["y"], 0) < max_rows:
            last[r["y"]] = r["cell"]
        total[r["y"]] = total.get(r["y"], 0) + r["n"]
    parts = [hashed.where((F.col("_c") == c) & (F.shiftright("_h", 54) <= cell)).orderBy("_h", "doc_id").limit(max_rows) for c, cell in last.items()]
    out = hashed.where("false")
    for p in parts:
        out = out.unionByName(p)
    return out.select("doc_id", "y"), total


def train(docs: DataFrame, truth: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit on the texts of at most ``max_rows`` labelled ids (doc_id, y), chosen by a hash of the id.

    Only statistics reach the driver: max_rows rows of them.
    """
    sample, _ = chosen(truth, max_rows, by_class=False)
    src = common.id_and_text(docs).join(F.broadcast(sample), "doc_id")  # max_rows rows

    def run(batch):
        x = matrix(common.utf8(batch))
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "x": pa.array(list(x), pa.list_(pa.float64()))}

    got = common.map_arrow(src.select("doc_id", "y", "text"), run, "doc_id long, y int, x array<double>")
    rows = got.groupBy("doc_id").agg(F.min_by("x", F.col("x")).alias("x"), F.max("y").alias("y")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))[order]
    return fit(x, rows.column("y").to_numpy().astype(np.float64)[order])


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row's whole text; null counts as empty; repeated rows are each answered."""

    def run(batch):
        return {"doc_id": batch.column("doc_id"), "score": pa.array(trees.score(matrix(common.utf8(batch))))}

    return common.map_arrow(common.id_and_text(docs, id_col, text_col), run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted: trained on the labelled ids outside fold 1 of 3, applied to every row."""
    truth = labelled(labels, "quality").where(fold(F.col("doc_id"), 3) != 1)
    scored = score(docs, train(docs, truth))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores ``threshold`` or more; trained on ``labelled_docs``.

    Null texts count as empty and stay null; repeated rows stay or go alike;
    without labels every score is 0.5, so all stay; an empty table gives an
    empty one.
    """
    truth = labelled(labels, "quality").where(fold(F.col("doc_id"), 3) != 1)
    trees = train(labelled_docs, truth)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = common.utf8(pa.RecordBatch.from_arrays([part.column(at)], names=["text"]))
                yield part.filter(pa.array(trees.score(matrix(texts)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
