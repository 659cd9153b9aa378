"""Fixtures with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, key string, a int, `_id` int, _th string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        k = min(n - len(out), rng.randint(3, 12))
        words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(k)]
        out += [*words[:-1], words[-1] + rng.choice([".", ".", "!", ".\n"])]
    return " ".join(out)


@pytest.fixture(scope="session")
def awkward_rows():
    base, passage = prose(1, 400), prose(2, 70)
    words = base.split(" ")
    near = " ".join([*words[:100], "changed", *words[101:]])
    texts = {
        1: base, 2: base, 3: near, 4: "", 5: None, 6: "   \n\t ", 7: "one", 8: "Two WORDS", 9: prose(3, 90) + " " + passage + " " + prose(4, 60),
        10: prose(5, 50) + " " + passage + " " + prose(6, 40), 11: "a" * 3000, 12: "ab " * 700, 13: prose(7, 9000), 14: "é ñ ü 你好 \U0001f600 naïve É", 15: "x" * 199, 16: "x" * 200,
        17: "x" * 201, 18: "Is it. " * 60, 19: base[:260], 20: "\x0b\x0c a\x85b c",
    }
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "k", 2, 3, "z") for i, t in texts.items()]
    rows += [rows[0], rows[4], (None, "no id here", None, None, 10, 1, None, 2, 3, "z"), (None, None, None, None, None, None, None, None, None, None), (-5, base, "de", None, 1, 1, "k", 2, 3, "z")]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
