"""Mixing to target weights with soft domain membership.

A classifier learnt from the labelled table gives every document a posterior
over domains. Document rates r >= 0 are then fitted so that the expected token
total of each domain, sum_i r_i * tokens_i * p_id, comes as near as possible to
its target (weighted least squares), by projected gradient steps from r = 1:

    e = sum_i r_i tokens_i p_i / T - target;  r_i <- max(0, r_i - p_i . (G^-1 e))

with G = sum_i tokens_i p_i p_i^T / T. G is the Hessian of the problem in the
token-weighted metric, so the step size is 1. A rate depends on the past steps
and p_i only: a pass over the documents replays the steps and returns one sum
per domain, and nothing per document is kept between passes or sent anywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, toxicity

SIZES = (5, 7)
BITS = 18
MAX_PER_DOMAIN = 2_000
DOMAINS = ("clean", "low", "toxic")


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and y: toxic (2) if any label says so, else low (1) if the quality is 0, else clean (0)."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
    rows = rows.where("doc_id is not null and (q is not null or t is not null)")
    one = rows.groupBy("doc_id").agg(F.max("t").alias("t"), F.min("q").alias("q"))
    return one.select("doc_id", F.when(F.col("t") == 1, 2).when(F.col("q") == 0, 1).otherwise(0).alias("y"))


def posteriors(docs: DataFrame, labelled_docs: DataFrame, truth: DataFrame, n_domains: int, max_per_domain: int = MAX_PER_DOMAIN) -> DataFrame:
    """doc_id, h (64-bit hash of the text), tokens (words) and p (posterior, sums to 1) of every row.

    One classifier per domain against the rest; their probabilities are
    normalised. Domains without labels get probability 1e-6 before that.
    """
    sample = toxicity.sample(labelled_docs, truth, SIZES, BITS, max_per_domain, n_domains)
    fits = [toxicity.fit(sample, d, BITS) if (sample.y == d).any() else (np.zeros(1 << BITS, np.float32), -14.0) for d in range(n_domains)]
    del sample
    common.release()
    shared = docs.sparkSession.sparkContext.broadcast((np.stack([t for t, _ in fits], axis=1), np.array([b for _, b in fits])))

    def run(batch):
        table, bias = shared.value
        grams = toxicity.Grams(SIZES, BITS)
        tokens, p = [], []
        for t in common.utf8(batch):
            tokens.append(len(t.split()))
            z = bias + table[grams.ids(t)].sum(axis=0, dtype=np.float64)
            q = np.maximum(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-6)
            p.append(q / q.sum())
        return {"doc_id": batch.column("doc_id"), "h": batch.column("h"), "tokens": tokens, "p": pa.array(p, pa.list_(pa.float64()))}

    src = common.id_and_text(docs).select("doc_id", F.xxhash64("text").alias("h"), "text")
    return common.map_arrow(src, run, "doc_id long, h long, tokens long, p array<double>")


def rates(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The rates of documents with posteriors ``p`` after the gradient steps."""
    r = np.ones(len(p))
    for v in steps:
        r = np.maximum(0.0, r - p @ v)
    return r


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_rates(table: DataFrame, targets: list[float], max_steps: int = 40, tolerance: float = 1e-7) -> np.ndarray:
    """The gradient steps that bring the expected shares to ``targets`` (in units of all tokens; need not sum to 1).

    ``table`` has tokens and p; without tokens there are no steps (all rates 1).
    """
    n = len(targets)
    goal = np.array(targets, float)

    def total(f, width: int) -> np.ndarray:
        """Sum over all documents of f(tokens, p), a vector."""

        def run(batches):
            acc = np.zeros(width)
            for b in batches:
                if b.num_rows:
                    acc += f(b.column("tokens").to_numpy().astype(float), _matrix(b.column("p"), n))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in acc], names=[f"s{i}" for i in range(width)])

        cols = [f"s{i}" for i in range(width)]
        part = table.select("tokens", "p").mapInArrow(run, ", ".join(f"{c} double" for c in cols))
        return np.array([x or 0.0 for x in part.agg(*[F.sum(c) for c in cols]).first()])

    gram = total(lambda t, p: np.r_[t.sum(), ((p * t[:, None]).T @ p).ravel()], 1 + n * n)
    tokens, steps = gram[0], []
    if not tokens:
        return np.zeros((0, n))
    inverse = np.linalg.pinv(gram[1:].reshape(n, n) / tokens, rcond=1e-9)
    last = np.full(n, np.inf)
    while len(steps) < max_steps:
        so_far = np.array(steps).reshape(-1, n)
        e = total(lambda t, p: (rates(p, so_far) * t) @ p, n) / tokens - goal
        if np.abs(e).max() < tolerance or np.abs(e - last).max() < tolerance:
            break
        last = e
        steps.append(inverse @ e)
    return np.array(steps).reshape(-1, n)


def rate_documents(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """doc_id, h, tokens, one posterior column per domain, rate and copies for every row.

    ``targets`` gives each domain's wanted token total as a multiple of its
    present expected total. copies rounds the rate at random so that its mean is
    the rate, by a hash of id and text: repeated rows get the same number.
    Null texts have no tokens and keep what their posterior says.
    """
    n = len(DOMAINS)
    table = common.materialize(posteriors(docs, labelled_docs, label_domains(labels), n), "posteriors")
    tokens = F.col("tokens").cast("double")
    now = table.agg(F.sum("tokens").alias("t"), *[F.sum(tokens * F.col("p")[d]).alias(f"d{d}") for d in range(n)]).first()
    steps = fit_rates(table, [targets[x] * (now[f"d{d}"] or 0.0) / (now["t"] or 1) for d, x in enumerate(DOMAINS)])

    def run(batch):
        p = _matrix(batch.column("p"), n)
        out = {"doc_id": batch.column("doc_id"), "h": batch.column("h"), "tokens": batch.column("tokens")}
        out |= {f"p_{x}": pa.array(p[:, d]) for d, x in enumerate(DOMAINS)}
        return out | {"rate": pa.array(rates(p, steps))}

    schema = "doc_id long, h long, tokens long, " + ", ".join(f"p_{x} double" for x in DOMAINS) + ", rate double"
    rated = common.map_arrow(table, run, schema, rows=8192)
    chance = F.pmod(F.xxhash64("doc_id", "h", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))


def mix(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The rows of ``docs`` (all columns), each as many times as its ``copies``; rows with none go.

    Rows alike in id and text get the same number each, be their other columns
    alike or not; null ids and null texts are matched as such; columns of any
    name are kept; an empty table gives an empty one.
    """
    copies = rate_documents(docs, labelled_docs, labels, targets).select("doc_id", F.col("h").alias("th"), "copies").distinct()
    joined = common.with_facts(docs, copies).where("copies > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
