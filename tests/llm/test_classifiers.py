import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lumenlink.llm import common, mixing, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("module", "label", "parts", "held"), [(quality, "quality", 3, 1), (toxicity, "toxic", 4, 2)])
def test_held_out_labels(spark, module, label, parts, held):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    rows = {r.doc_id: r for r in module.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % parts == held) and 0 <= r.score <= 1 for i, r in rows.items())
    truth = [(rows[r.doc_id], r[label]) for r in labels.collect()]
    test = [(r.score, y, r.predicted) for r, y in truth if r.held_out]
    s, y, p = map(np.array, zip(*test, strict=True))
    assert len(test) > 500 and auc(y, s) > 0.97 and (p == y).mean() > 0.96


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(spark, awkward, awkward_rows, nothing, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 20)] + [(None, 1, 1), (3, None, None), (4, 0, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    out = module.classify(awkward, labels).collect()
    assert len(out) == len(awkward_rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    for none in (labels.where("false"), labels.where("quality = 1")):
        out = module.classify(awkward, none).collect()
        assert len(out) == len(awkward_rows) and len({r.score for r in out}) == 1
    assert module.classify(nothing, labels).collect() == []


def test_trees_walk_as_a_plain_loop():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y, n_trees=30)

    def plain(row):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += v[at - len(f)]
        return total

    assert np.allclose(trees.raw(x[:50]), [plain(r) for r in x[:50]])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_distinct_grams():
    grams = toxicity.Grams((4, 5), 18)
    text = "Abc  abc abcd\n".encode() * 30
    clean = b" " + b" ".join(text.lower().split()) + b" "
    kinds = {g for n in (4, 5) for i in range(len(clean) - n + 1) if b" " not in (g := clean[i : i + n])[1:-1]}
    ids = grams.ids(text)
    assert len(set(ids.tolist())) == len(ids) == len(kinds)
    assert len(grams.ids(b"")) == 0


def test_quality_filter_keeps_good_rows(spark, awkward):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    kept = quality.keep_good(docs, docs, labels)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert kept.columns == docs.columns and len(good & ids) > 0.99 * len(good) and len(bad & ids) < 0.05 * len(bad)
    assert quality.keep_good(awkward, docs, labels).columns == awkward.columns


SMALL = "/root/testdata/sf0.001"


def plain_rows(spark, label, parts, held):
    """Texts by id, and the labelled ids outside the fold with their label, in plain Python."""
    texts = {r.doc_id: (r.text or "").encode() for r in common.table(spark, SMALL, "documents").collect()}
    truth = {r.doc_id: r[label] for r in common.table(spark, SMALL, "labels").collect() if zlib.crc32(str(r.doc_id).encode()) % parts != held and r.doc_id in texts}
    return texts, dict(sorted(truth.items()))


def test_quality_query_is_brute_force(spark):
    texts, truth = plain_rows(spark, "quality", 3, 1)
    trees = quality.fit(np.array([quality.statistics(texts[i]) for i in truth]), np.array(list(truth.values()), float))
    for r in queries.op2_quality(spark, SMALL).collect():
        x, total = quality.statistics(texts[r.doc_id]), trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if x[f[at]] > t[at] else 1)
            total += v[at - len(f)]
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9 and r.predicted == (r.score >= 0.5)


def plain_grams(text, sizes, bits):
    """Distinct hashed n-grams of words with a blank at either end, one at a time."""
    clean, out = b" " + b" ".join(text.lower().split()) + b" ", set()
    for n in sizes:
        for i in range(len(clean) - n + 1):
            g = clean[i : i + n]
            if b" " not in g[1:-1]:
                h = sum(c * toxicity._MULT[k] for k, c in enumerate(g)) % 2**32
                out.add((h ^ h >> 15) * (0x2C1B3C6D + 2 * n) % 2**32 >> 32 - bits)
    return out


def plain_fit(grams, y, weight, bits, ridge=0.5):
    """Log-count ratios and ridge logistic regression on a dense matrix, by plain gradient steps until nothing moves."""
    n = len(y)
    total, counts = weight.sum(), [Counter(), Counter()]
    for g, label in zip(grams, y, strict=True):
        counts[int(label)].update(g)
    ratio = {g: math.log((counts[1][g] + 1) / (y.sum() + 2)) - math.log((counts[0][g] + 1) / (n - y.sum() + 2)) for g in set(counts[0]) | set(counts[1]) if counts[0][g] + counts[1][g] >= 3}
    used = sorted(g for g, r in ratio.items() if abs(r) > 1)
    x = np.array([[ratio[g] if g in own else 0.0 for g in used] for own in grams]).reshape(n, len(used))
    scale = weight * n / total
    w, b = np.zeros(len(used)), math.log((weight @ y + 0.5) / (total - weight @ y + 0.5))
    step = 1 / (0.25 * np.linalg.norm(np.sqrt(scale)[:, None] * np.c_[x, np.ones(n)], 2) ** 2 + ridge)
    v = np.r_[w, b]
    ahead, momentum = v.copy(), 1.0
    for _ in range(4000):
        e = scale * (1 / (1 + np.exp(-(x @ ahead[:-1] + ahead[-1]))) - y)
        new = ahead - step * np.r_[x.T @ e + ridge * ahead[:-1], e.sum()]
        turn = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, v, momentum = new + (momentum - 1) / turn * (new - v), new, turn
    return {g: ratio[g] * a for g, a in zip(used, v[:-1], strict=True)}, v[-1]


def test_toxicity_query_is_brute_force(spark):
    texts, truth = plain_rows(spark, "toxic", 4, 2)
    grams = {i: plain_grams(t, toxicity.SIZES, toxicity.BITS) for i, t in texts.items()}
    y = np.array(list(truth.values()), float)
    table, bias = plain_fit([grams[i] for i in truth], y, np.ones(len(y)), toxicity.BITS)
    for r in queries.op4_toxicity(spark, SMALL).collect():
        z = bias + sum(table.get(g, 0.0) for g in grams[r.doc_id])
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 0.02 and r.predicted == (r.score >= 0.3)


def test_grams_across_the_seam_of_blocks(monkeypatch):
    text = " ".join(f"w{k}rd" for k in range(400)).encode()
    whole = set(toxicity.Grams().ids(text).tolist())
    assert whole == plain_grams(text, toxicity.SIZES, toxicity.BITS)
    monkeypatch.setattr(toxicity, "_BLOCK", 97)
    parts = toxicity.Grams().ids(text).tolist()
    assert set(parts) == whole and len(parts) == len(whole)


def test_filters_of_empty_tables(spark, nothing):
    labels = common.table(spark, SMALL, "labels")
    assert quality.keep_good(nothing, common.table(spark, SMALL, "documents"), labels).collect() == []
    assert quality.keep_good(nothing, nothing, labels).collect() == []


def test_sample_is_bounded_by_class(spark):
    truth = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(5000)], "doc_id long, y int")
    rows, counts = quality.chosen(truth, 700)
    got = rows.collect()
    assert counts == {0: 4500, 1: 500} and Counter(r.y for r in got) == {0: 700, 1: 500} and len({r.doc_id for r in got}) == 1200
    rows, _ = quality.chosen(truth, 700, by_class=False)
    assert rows.count() == 700 and quality.chosen(truth.where("false"), 700)[0].count() == 0


# ---------------------------------------------------------------- mixing


def test_mixing_query_is_brute_force(spark):
    """Posteriors from plain fits, rates from a loop on one machine: the query's rows."""
    texts = {r.doc_id: (r.text or "").encode() for r in common.table(spark, SMALL, "documents").collect()}
    truth = {r.doc_id: 2 if r.toxic else 1 if not r.quality else 0 for r in common.table(spark, SMALL, "labels").collect() if r.doc_id in texts}
    truth, grams = dict(sorted(truth.items())), {i: plain_grams(t, mixing.SIZES, mixing.BITS) for i, t in texts.items()}
    y, fits = np.array(list(truth.values())), []
    for d in range(3):
        fits.append(plain_fit([grams[i] for i in truth], (y == d).astype(float), np.ones(len(y)), mixing.BITS))
    rows = {r.doc_id: r for r in queries.op8_mixing(spark, SMALL).collect()}
    ids = sorted(texts)
    q = np.array([[max(1 / (1 + math.exp(-min(30, max(-30, b + sum(t.get(g, 0.0) for g in grams[i]))))), 1e-6) for t, b in fits] for i in ids])
    p, tokens = q / q.sum(axis=1, keepdims=True), np.array([len(texts[i].split()) for i in ids], float)
    assert [rows[i].tokens for i in ids] == tokens.tolist()
    own = np.array([[rows[i].p_clean, rows[i].p_low, rows[i].p_toxic] for i in ids])
    assert np.abs(own - p).max() < 0.03
    p = own  # from here on exactly
    goal, gram = np.array([queries.MIX[d] for d in mixing.DOMAINS]) * (tokens @ p) / tokens.sum(), (p * tokens[:, None]).T @ p / tokens.sum()
    rate = np.ones(len(ids))
    for _ in range(40):
        rate = np.maximum(0, rate - p @ np.linalg.solve(gram, (rate * tokens) @ p / tokens.sum() - goal))
    assert np.allclose([rows[i].rate for i in ids], rate, atol=1e-3)
    assert all(rows[i].copies in (math.floor(rows[i].rate), math.floor(rows[i].rate) + 1) for i in ids)


def test_rates_meet_the_targets(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    targets = {"clean": 1.1, "low": 0.3, "toxic": 0.2}
    rows = mixing.rate_documents(docs, docs, labels, targets).collect()
    t = np.array([r.tokens for r in rows])
    for d, x in targets.items():
        p = np.array([r[f"p_{d}"] for r in rows])
        assert np.isclose((np.array([r.rate for r in rows]) * t * p).sum(), x * (t * p).sum(), rtol=1e-4)
    assert all(r.rate >= 0 and abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-9 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)


def test_steps_are_those_of_a_plain_projected_gradient(spark):
    """Targets that cannot be met, so that rates reach 0: the replayed steps give the rates of a loop on one machine."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet([1, 1, 1], 200)
    t = rng.integers(5, 200, 200).astype(float)
    goal = np.array([0.5, 0.0, 0.9])
    table = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(t, p, strict=True)], "tokens double, p array<double>")
    r = mixing.rates(p, mixing.fit_rates(table, goal.tolist(), max_steps=25, tolerance=1e-12))
    g = np.linalg.inv((p * t[:, None]).T @ p / t.sum())
    x, losses = np.ones(200), []
    for _ in range(25):
        e = (x * t) @ p / t.sum() - goal
        losses.append(e @ g @ e)
        x = np.maximum(0, x - p @ (g @ e))
    assert np.allclose(r, x, atol=1e-9) and (r == 0).any() and (np.diff(losses) <= 1e-12).all()


def test_mix_awkward_rows(spark, awkward, nothing):
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    want = {"clean": 1.0, "low": 0.5, "toxic": 0.5}
    out = mixing.mix(awkward, docs, labels, want)
    assert out.columns == awkward.columns
    out.collect()
    assert mixing.mix(nothing, docs, labels, want).collect() == []
    none = mixing.rate_documents(awkward, docs, labels.where("false"), want).collect()
    assert len(none) == awkward.count()
