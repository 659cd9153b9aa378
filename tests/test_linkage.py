"""Blocking, features, evaluation and the end-to-end runs."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenlink import schema
from lumenlink.operators import blocking, evaluate, features, model, order, predict
from lumenlink.plans import lifecycles
from lumenlink.schema import BlockingOptions
from lumenlink.sources import tables
from tests.test_text import RECORDS

SOURCE = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, *r) for i, r in RECORDS.items()]
    return [spark.createDataFrame([r for r in rows if r[0].startswith(s)], SOURCE) for s in ("S1", "S2", "S3")]


def test_token_blocking_golden(sources):
    q, *targets = sources
    out = lifecycles.candidates(q, tables.union_targets(*targets)).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.target_id, r.score))
    assert got == {"S1-001": [("S2-001", 1002)], "S1-002": [("S3-002", 1003), ("S2-002", 3)], "S1-004": [("S2-004", 3)]}
    lists = blocking.candidate_lists(lifecycles.token_records(q), lifecycles.candidates(q, tables.union_targets(*targets)))
    assert {r[0]: r[1] for r in lists.collect()} == {"S1-001": "S2-001", "S1-002": "S3-002,S2-002", "S1-003": "", "S1-004": "S2-004"}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_pair_features_golden(sources, spark):
    q, *targets = sources
    raw = {i: tuple(x.strip().lower() for x in r) for i, r in RECORDS.items()}
    like = lambda a, b: round(1 - edit_distance(a, b) / max(len(a), len(b)), 6) if a and b else 0.0
    want = {}
    for x, y in [("S1-001", "S2-001"), ("S1-001", "S3-001"), ("S1-002", "S2-002"), ("S1-002", "S3-002"), ("S1-004", "S2-004"), ("S1-001", "S2-002")]:
        (n, a, c), (m, b, d) = raw[x], raw[y]
        jw = duckdb.execute("select round(jaro_winkler_similarity(?, ?), 6)", [n, m.replace("ó", "#")]).fetchall()[0][0]  # DuckDB compares bytes
        want[x, y] = (int(n == m), int(a == b != ""), int(c == d), like(n, m), jw, like(a, b), abs(len(n) - len(m)), abs(len(a) - len(b)))
    assert want["S1-001", "S3-001"][1] == 1 and want["S1-004", "S2-004"][5] == 0.0
    pairs = spark.createDataFrame([*want, ("S1-001", "gone"), ("gone", "S2-001")], "source1_entity_id string, candidate_entity_id string")
    out = features.pair_features(pairs, q, tables.union_targets(*targets)).collect()
    assert {(r[0], r[1]): tuple(round(x, 6) for x in r[2:]) for r in out} == want
    assert features.pair_features(pairs, q, tables.union_targets(*targets)).schema.names == schema.FEATURES.names


def naive_block(q, t, o):
    """The definition, in loops: shared rare tokens, equal names, first k by score, source, id."""
    df = {}
    words = lambda n: {w for w in n.split() if len(w) >= o.min_token}
    for _, _, n, c in t:
        for w in words(n):
            df[w, c] = df.get((w, c), 0) + 1
    out = set()
    for i, n, c in q:
        s = []
        for src, j, m, d in t:
            if c == d:
                score = sum(df[w, c] < o.max_df for w in words(n) & words(m)) + o.exact_bonus * (n == m != "")
                if score:
                    s.append((-score, src, j))
        out |= {(i, src, j, -x, k) for k, (x, src, j) in enumerate(sorted(s)[: o.k], 1)}
    return out


def test_blocking_is_the_definition_with_hot_names(spark):
    """A third of the records bear one name; words are shared by many; some names are empty."""
    rng = random.Random(4)
    name = lambda: "hot name ltd" if rng.random() < 0.33 else " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zz"]) for _ in range(rng.randint(0, 3)))
    q = [(f"q{i}", name(), rng.choice("xy")) for i in range(60)]
    t = [(rng.randint(0, 1), f"t{i}", name(), rng.choice("xy")) for i in range(120)]
    for o in (BlockingOptions(k=7, max_df=40), BlockingOptions(k=200), BlockingOptions(k=3, max_df=2, min_token=2)):
        out = blocking.block_tokens(spark.createDataFrame(q, "id string, name string, country string"), spark.createDataFrame(t, "src int, id string, name string, country string"), o)
        assert {tuple(r) for r in out.select("query_id", "src", "target_id", "score", "rank").collect()} == naive_block(q, t, o)


def test_no_candidates_from_empty_tables(spark):
    q = spark.createDataFrame([], "id string, name string, country string")
    t = spark.createDataFrame([], "src int, id string, name string, country string")
    assert blocking.block_tokens(q, t).collect() == [] and blocking.exact_pairs(q, t).collect() == []


def test_blocking_plan_has_no_all_pairs_join(sources):
    q, *targets = sources
    plan = lifecycles.candidates(q, tables.union_targets(*targets))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_country_is_asked_after_the_nearest_are_taken(spark):
    q = spark.createDataFrame([("q1", "n", "us", "red apple pie"), ("q2", "n2", "", "red apple pie")], "id string, name string, country string, body string")
    t = spark.createDataFrame([(0, f"t{i}", "m", c, "red apple pie") for i, c in enumerate(["in", "in", "us"])], "src int, id string, name string, country string, body string")
    out = blocking.block_tfidf(q, t, blocking.TfidfOptions(k=2)).collect()
    assert {tuple(r) for r in out} == {("q2", "t0"), ("q2", "t1")}


def test_sources_round_trip(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('entity_id\tbusiness_name\taddress\tcountry\nA\t"say ""hi""\nthere"\t1 Road\tUS\nB\tshort\n', encoding="utf-8")
    got = tables.read_source(spark, str(path)).orderBy("entity_id").collect()
    assert tuple(got[0])[:4] == ("A", 'say "hi"\nthere', "1 Road", "US") and tuple(got[1])[:4] == ("B", "short", "", "")
    lists = spark.createDataFrame([("q1", "t2,t1"), ("q2", ""), ("q3", " a , ,b ")], schema.TRUTH)
    assert tables.explode_list(lists, "source1_entity_id", "matched_entity_ids", "e", trimmed=True).count() == 4
    out = str(tmp_path / "out")
    tables.write_delimited(lists, out)
    back = {r[0]: r[1] for r in tables.read_delimited(spark, out).collect()}
    assert back["q1"] == "t2,t1" and not back["q2"]
    feats = spark.createDataFrame([("q", "007", 1, 0, 1, 0.5, 0.25, 0.0, 3, 4)], schema.FEATURES)
    tables.write_delimited(feats, str(tmp_path / "f"), ",")
    again = tables.read_features(spark, str(tmp_path / "f"))
    assert again.schema == schema.FEATURES and again.first() == feats.first()


def test_last_source_wins(spark):
    a = spark.createDataFrame([("x", "old", "", ""), ("y", "only", "", "")], SOURCE)
    b = spark.createDataFrame([("x", "new", "", "")], SOURCE)
    out = tables.last_wins(tables.union_targets(a, b), "entity_id", "src")
    assert {r.entity_id: r.business_name for r in out.collect()} == {"x": "new", "y": "only"}


def test_last_row_of_a_file_wins(spark, tmp_path):
    """Not the greatest row: in a file the last one holds, in every form and after a shuffle."""
    rows = [("X", "Zeta", "", ""), ("Y", "One", "", ""), ("X", "Alpha", "", ""), ("Y", "", "", "")] + [(f"k{i % 50}", f"v{999 - i}", "", "") for i in range(1000)]
    path = tmp_path / "s.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rows))
    spark.createDataFrame(rows, SOURCE).coalesce(1).write.parquet(str(tmp_path / "p"))
    want = {k: n for k, n, _, _ in rows}
    for df in (tables.read_source(spark, str(path)), tables.read_source(spark, str(tmp_path / "p"), "parquet")):
        got = tables.last_wins(df.repartition(5, "business_name"), "entity_id").collect()
        assert {r.entity_id: r.business_name for r in got} == want
        assert {r.entity_id: r.name for r in features.keyed(df).collect()} == {k: v.lower() for k, v in want.items()}


def test_last_list_of_a_record_wins(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\na\tz,y\na\tb,c\na\t\nb\t\n")
    got = tables.read_candidates(spark, str(tmp_path / "c.tsv")).collect()
    assert sorted(map(tuple, got)) == [("a", "b"), ("a", "c")]  # an empty list does not replace one
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\na\tz,y\na\tb , c\nb\tx\nb\t\n")
    got = tables.read_truth(spark, str(tmp_path / "t.tsv")).collect()
    assert sorted(map(tuple, got)) == [("a", "b"), ("a", "c")]  # here it does


def test_lists_are_written_in_the_order_of_the_queries(spark, tmp_path):
    ids = [f"q{i * 7919 % 1000}" for i in range(1000)]
    (tmp_path / "s.tsv").write_text("entity_id\n" + "\n".join(ids) + "\n")
    q = tables.read_source(spark, str(tmp_path / "s.tsv"))
    m = spark.createDataFrame([(i, f"t{i}") for i in ids[::3]], "source1_entity_id string, candidate_entity_id string")
    tables.write_delimited(predict.match_lists(q, m, placed=True), str(tmp_path / "out"))
    lines = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()[1:]]
    assert [x.split("\t")[0] for x in lines] == ids
    assert predict.match_lists(q, m).columns == ["source1_entity_id", "matched_entity_ids"]


def test_first_rows_without_a_sort(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 2, 3, 50, 51]), f"w{rng.randint(0, 400):03d}") for _ in range(700)]
    df = spark.createDataFrame(rows, "total long, term string")
    for n in (0, 7, 699, 900):
        got = order.first_n(df, n, [-F.floor(F.log2(F.col("total").cast("double")) * 4), -F.col("total"), F.substring("term", 1, 2)], [F.desc("total"), "term"])
        assert sorted(map(tuple, got.collect())) == sorted(sorted(rows, key=lambda r: (-r[0], r[1]))[:n])


def test_tfidf_may_be_fitted_on_a_sample(spark):
    t = spark.createDataFrame([(0, f"t{i}", f"w{i % 7} common x{i}") for i in range(300)], "src int, id string, body string")
    options = blocking.TfidfOptions(sample=100, min_df=1)
    rows = blocking.fit_rows(t, options).collect()
    assert len(rows) == len({r.id for r in rows}) == 100 and sorted(rows) == sorted(blocking.fit_rows(t.repartition(7), options).collect())
    assert sorted(rows) != sorted(blocking.fit_rows(t, blocking.TfidfOptions(sample=100, seed=7)).collect())
    _, w = blocking.tfidf_weights(t.select("id", "body"), t, options)
    known = {r.term for r in w.collect()}
    assert known == {x for r in rows for x in r.body.split()} and blocking.fit_rows(t, blocking.TfidfOptions()).count() == 300


def test_curve_and_threshold(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 60) / 60, rng.random()) for _ in range(400)]
    rows = [(s, int(u < s * s)) for s, u in rows]
    df = spark.createDataFrame(rows, "score double, is_match int")
    curve = {r.threshold: r for r in evaluate.pr_curve(df).collect()}
    total = sum(y for _, y in rows)
    for t, r in curve.items():
        tp = sum(y for s, y in rows if s >= t)
        m = sum(s >= t for s, _ in rows)
        p, rec = tp / m, tp / total
        f = 1.25 * p * rec / (0.25 * p + rec) if 0.25 * p + rec else 0.0
        assert abs(r.precision - p) < 1e-12 and abs(r.recall - rec) < 1e-12 and abs(r.f05 - f) < 1e-12
    best = evaluate.best_threshold(evaluate.pr_curve(df)).first()
    top = max(r.f05 for r in curve.values())
    assert best.threshold == min(t for t, r in curve.items() if abs(r.f05 - top) < 1e-12)
    assert evaluate.best_threshold(evaluate.pr_curve(df.where("false"))).first() is None
    assert all(r.f05 == 0 for r in evaluate.pr_curve(df.withColumn("is_match", F.lit(0))).collect())


def test_predictions(spark):
    q = spark.createDataFrame([("a", "", "", ""), ("a", "", "", ""), ("b", "", "", "")], SOURCE)
    s = spark.createDataFrame([("a", "t2", 0.9), ("a", "t1", 0.5), ("a", "t1", 0.7), ("b", "t3", 0.1)], "source1_entity_id string, candidate_entity_id string, score double")
    hits = predict.apply_threshold(s, 0.5)
    lists = predict.match_lists(q, hits)
    assert sorted(map(tuple, lists.collect())) == [("a", "t1,t1,t2"), ("a", "t1,t1,t2"), ("b", "")]
    assert [r[0] for r in predict.singletons(q, hits).collect()] == ["b"]
    assert tuple(predict.match_summary(lists).first()) == (3, 2, 6, 2 / 3)


def corpus(spark, n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    q, t, truth = [], [], []
    for i in range(n):
        name, address = f"{word()} {word()} {word()}", f"{i} {word()} street"
        q.append((f"S1-{i}", name, address, "US"))
        if i % 4:
            t.append((f"S2-{i}", name.upper() + " Inc", address, "US"))
            truth.append((f"S1-{i}", f"S2-{i}"))
        else:
            truth.append((f"S1-{i}", ""))
        t.append((f"S2-x{i}", f"{name.split()[0]} {word()} {word()}", f"{i} {word()} avenue", "US"))
    return spark.createDataFrame(q, SOURCE), spark.createDataFrame(t, SOURCE), spark.createDataFrame(truth, schema.TRUTH)


def test_train_match_save_and_stream(spark, tmp_path):
    from lumenlink.streaming import match

    q, t, truth = corpus(spark, 120, 1)
    fitted = lifecycles.train_pipeline(q, [t], truth, iterations=5)
    lists = {r[0]: r[1] for r in lifecycles.match_pipeline(q, [t], fitted).collect()}
    want = {r[0]: r[1] for r in truth.collect()}
    assert sum(lists[k] == v for k, v in want.items()) > 0.95 * len(want)
    fitted.save(str(tmp_path / "model"))
    again = model.Model.load(spark, str(tmp_path / "model"))
    assert again.threshold == fitted.threshold and again.features == schema.FEATURE_COLUMNS
    q.write.parquet(str(tmp_path / "in"))
    got = {}
    stream = spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))
    match.match_stream(stream, [t], again, lambda df, _: got.update({r[0]: r[1] for r in df.collect()}), str(tmp_path / "ck")).awaitTermination(120)
    assert got == lists


def test_split_keeps_groups_whole(spark):
    for n in (1, 303):
        df = spark.createDataFrame([(f"g{i % n}", i, int(i % n == 0)) for i in range(3 * n)], "source1_entity_id string, i int, is_match int")
        train, test = model.group_split(df)
        a, b = ({r[0] for r in x.select("source1_entity_id").distinct().collect()} for x in (train, test))
        assert not a & b and len(a | b) == n and len(b) == -(-n // 5) and train.columns == df.columns
        stats = {r.side: r for r in model.split_stats(model.with_side(df)).collect()}
        assert stats["test"].pairs == 3 * len(b) and sum(r.positives for r in stats.values()) == 3


def test_alike_pairs_are_boosted_as_one_weighted_row(spark, monkeypatch):
    """F2: every pair counts, but trees are made of one row for each distinct vector and label; the scores are those of all pairs."""
    from pyspark.ml import Pipeline

    names = schema.FEATURE_COLUMNS
    kinds = ", ".join(f"{c} double" for c in names)
    distinct = [(*[float((i * (k + 3)) % (k + 2)) for k in range(len(names) - 1)], i / 40, int(i % 3 == 0)) for i in range(40)]
    df = spark.createDataFrame([x for i, x in enumerate(distinct) for _ in range(1 + i)], f"{kinds}, is_match int")
    positives = sum(1 + i for i in range(40) if i % 3 == 0)
    seen, fit = [], Pipeline.fit

    def counted(self, rows, *more):
        seen.append(rows.agg(F.count("*"), F.sum("weight")).first())
        return fit(self, rows, *more)

    monkeypatch.setattr(Pipeline, "fit", counted)
    for early in (model.EARLY_STOP_ROWS, 100):
        monkeypatch.setattr(model, "EARLY_STOP_ROWS", early)
        model.fit(df, iterations=4)
        assert seen[-1][0] == 40 and abs(seen[-1][1] - 2 * (820 - positives)) < 1e-6
    monkeypatch.setattr(model, "EARLY_STOP_ROWS", 10_000)
    made = model.fit(df, iterations=4)
    one_by_one = df.withColumn("n", F.lit(1))
    plain = model._boost(one_by_one, names, 4, 42)
    a, b = ({tuple(r)[:-1]: r["score"] for r in model.score(p, df).collect()} for p in (made, plain))
    assert a.keys() == b.keys() and len(a) == 40 and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_curve_of_rows_that_stand_for_many_pairs(spark):
    rows = [(i / 7, i % 2, 1 + i) for i in range(8)]
    few = spark.createDataFrame(rows, "score double, is_match int, n long")
    many = spark.createDataFrame([r[:2] for r in rows for _ in range(r[2])], "score double, is_match int")
    assert sorted(evaluate.pr_curve(few, n="n").collect()) == sorted(evaluate.pr_curve(many).collect())
