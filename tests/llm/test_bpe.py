import hashlib
import random
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lumenlink.llm import bpe, common, queries


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(queries.RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_is_the_library(spark, sf, library):
    want = Counter(digest(library, r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect())
    assert Counter(map(tuple, queries.op9_bpe(spark, sf).collect())) == want


def test_awkward_rows(awkward, awkward_rows, library):
    for held in (bpe.WORDS_HELD, 1, 300):
        out = bpe.encode_documents(awkward, queries.RANKS, public_tokenizers.PATTERN, words_held=held)
        assert Counter(map(tuple, out.collect())) == Counter(digest(library, r[0], r[1]) for r in awkward_rows)


def test_words_go_through_the_fold(awkward, ranks, monkeypatch):
    """Only words of over FOLD_BYTES bytes are merged elsewhere, and nothing is shuffled."""
    rows = bpe._words(common.id_and_text(awkward), ranks, public_tokenizers.PATTERN, 100).collect()
    words = [r for r in rows if r.word is not None]
    assert any(r.ready for r in words) and all((r.ready is not None) == (len(r.word) > bpe.FOLD_BYTES) for r in words)
    plan = bpe.encode_documents(awkward, queries.RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0] and "aggregate(" in plan


def test_empty_table(nothing):
    assert bpe.encode_documents(nothing, queries.RANKS, public_tokenizers.PATTERN).collect() == []


def test_fold_and_decoding_in_spark(spark, ranks, library):
    words = [b"", b"a", b" the", b" ofonreblend", "éêçñü".encode(), b"!!!!!!!!!!!!!", "你好世界".encode(), b"aaaaaaaaaaaaaaa", bytes(range(128, 150)), b"zqxjkvbw", b" Tionnterthhe"]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    rank_map = bpe.RankMap(ranks)
    rows = bpe.encode_words(df, ranks).withColumn("back", rank_map.decode_ids(F.col("ids"))).collect()
    for r in rows:
        w = bytes(r.word)
        assert list(r.ids) == (library._encode_single_piece(w) if w else [])
        assert bytes(r.back) == w


def test_fold_holds_one_array_and_cuts_none_out(spark, ranks, library):
    """A step makes its array anew once: no struct of arrays as the state, no slices. Few letters, so that ranks tie."""
    rng = random.Random(9)
    words = [bytes(rng.choice(b"aehnt ") for _ in range(rng.randint(2, 14))) for _ in range(400)] + [b"aaaaaaa", b"ananananan", b"hahahahaha"]
    out = bpe.encode_words(spark.createDataFrame([(w,) for w in words], "word binary"), ranks)
    assert all(list(r.ids) == library._encode_single_piece(bytes(r.word)) for r in out.collect())
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" in plan and "slice(" not in plan


def test_heap_merges_long_words(ranks, library):
    for w in (b"a" * 5000, b"abcabd" * 700, "éà".encode() * 600, b"the" * 1000):
        assert bpe.merge_word(w, ranks) == library._encode_single_piece(w)


def test_ids_and_decoded_are_kept(awkward, awkward_rows):
    out = bpe.encode_documents(awkward, queries.RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in out) == Counter((x[0], (x[1] or "").encode()) for x in awkward_rows)
    assert all(len(r.ids) == r.n_tokens for r in out)
