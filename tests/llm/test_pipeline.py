import ast
import pathlib

import corpus_pipeline
from lumenlink.llm import common, queries

ROOT = pathlib.Path(corpus_pipeline.__file__).parent


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = first = common.table(spark, sf, "documents")
    labels = {r.doc_id: r for r in common.table(spark, sf, "labels").collect()}
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf), "stage")
        assert docs.columns == first.columns, name
        counts.append(docs.count())
        if name == "quality classifier":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            good = [i for i, r in labels.items() if r.quality == 1]
            assert sum(i in kept for i in good) > 0.99 * len(good)
        if name == "SimHash near-dedup":
            assert docs.select("text").distinct().count() == docs.count() == docs.select("doc_id").distinct().count()
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == counts[-1]
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_of_awkward_and_empty_tables(spark, awkward, nothing):
    """Nulls, repeats and clashing names go through all stages; no rows stay none."""
    sf = "/root/testdata/sf0.001"
    for docs in (awkward, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.materialize(stage(spark, docs, sf), "stage")
            assert docs.columns == columns, name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert out.count() == docs.count()
    assert out.count() == 0


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "lumenlink").rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [f"{node.module}.{a.name}" for a in node.names] if isinstance(node, ast.ImportFrom) else []
                assert not any("lumenlink.llm" in n for n in names), path
