"""Golden rows of the normalisation profiles."""

import random

import pytest
from pyspark.sql import functions as F

from lumenlink.functions import similarity, text

RECORDS = {
    "S1-001": ("Marlow Green Co", "418 Quarry Hill Lane, Durham, NC", "US"),
    "S2-001": ("MARLOW GREEN [CO]", "419 QUARRY HILL LANE, DRUHAM TOWN, NC", "US"),
    "S3-001": ("MG", "418 Quarry Hill Lane, Durham, NC", "US"),
    "S1-002": ("Heart Surgeons of Ashland", "77 Virginia Street, Ashland, OR", "US"),
    "S2-002": ("Heart Surgeons of Ashland Corporation", "77 VIRGINIA SAINT, ASHLAND, OR", "US"),
    "S3-002": ("Heart-Surgeons of Ashland", "7 Virginia Street, PO Box 31, Ashland, Oregon", "US"),
    "S1-003": ("Silver Ventures Pvt Ltd", "Plot No.B-22, 3Rd Cross, Sri Sai Towers, Mysore, Karnataka", "India"),
    "S1-004": ("Bureau Kalo Trade Agents", "Stall No. H-02-D, Lake Road, Kota, Rajasthan", "India"),
    "S2-004": ("BUREAU KALÓTE TRADE AGENTS", "", "India"),
}
EXPECTED = {
    "S1-001": ("marlow green co", "marlow green company", "418 quarry hill lane durham nc", "marlow green company", None),
    "S2-001": ("marlow green co", "marlow green company", "419 quarry hill lane druham town nc", "marlow green company", None),
    "S3-001": ("mg", "mg", "418 quarry hill lane durham nc", "mg", None),
    "S1-002": ("heart surgeons of ashland",) * 2 + ("77 va street ashland or", "heart surgeons of ashland", None),
    "S2-002": ("heart surgeons of ashland corporation",) * 2 + ("77 va saint ashland or", "heart surgeons of ashland corporation", None),
    "S3-002": ("heart surgeons of ashland",) * 2 + ("7 va street ashland or", "heart surgeons of ashland", None),
    "S1-003": ("silver ventures pvt ltd", "silver ventures private limited", "plot no b 22 3rd cross sri sai towers mysore ka", "silver ventures private limited", None),
    "S1-004": ("bureau kalo trade agents",) * 2 + ("stall no h 02 d lake road kota rj", "bureau kalo trade agents", None),
    "S2-004": ("bureau kal te trade agents",) * 2 + ("", "bureau kalote trade agents", None),
}
NAMES = [
    ("Acme  Mfg. Co., Inc.", "acme mfg co inc", "acme manufacturing company incorporated", "acme manufacturing company incorporated"),
    ("A.B.C. Pvt. Ltd.", "a b c pvt ltd", "a b c private limited", "a b c private limited"),
    ("T/A Blue Sol", "t a blue sol", "t a blue solutions", "dba blue solutions"),
    ("TA Tech Intl", "ta tech intl", "ta tech international", "dba technology international"),
    ("L.T.Designs", "l t designs", "l t designs", "l t designs"),
    ("P.V.Technology (L.T.D)", "p v technology l t d", "p v technology l t d", "p v technology limited"),
    ("Smith\tSons LLC", "smith\tsons llc", "smith\tsons llc", "smith\tsons llc"),
    (None, "", "", ""),
    ("", "", "", ""),
]
ADDRESSES = [
    ("PO Box Springfield, Illinois", "il", "springfield il"),
    ("P.O. Box 12-A, Goa", "goa", "a ga"),
    ("No. 536-B, Near Temple, Opp Bank, Ste 4, New Delhi", "no 536 b near temple opp bank ste 4 new dl", "number 536 b temple bank suite 4 new dl"),
    ("1 Main, New  York", "1 main new york", "1 main new york"),
    ("1 Main, New\tYork, new york", "1 main new\tyork ny", "1 main new\tyork ny"),
    ("1 Washington Ave, West Virginia", "1 wa ave wv", "1 wa avenue wv"),
]


def apply(spark, values, *profiles):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", *[p(F.col("v")).alias(f"p{k}") for k, p in enumerate(profiles)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_record_profiles(spark):
    ids = list(EXPECTED)
    names = apply(spark, [RECORDS[i][0] for i in ids], text.name_token, text.name_tfidf, text.name_rich)
    addresses = apply(spark, [RECORDS[i][1] for i in ids], text.address_tfidf, text.address_rich)
    for i, n, a in zip(ids, names, addresses, strict=True):
        e = EXPECTED[i]
        assert n == (e[0], e[1], e[3]) and a == (e[2], e[2]), i
    assert apply(spark, [" US ", None, "India"], text.country) == [("us",), ("",), ("india",)]


def test_edge_names(spark):
    assert apply(spark, [n[0] for n in NAMES], text.name_token, text.name_tfidf, text.name_rich) == [n[1:] for n in NAMES]


def test_edge_addresses(spark):
    assert apply(spark, [a[0] for a in ADDRESSES], text.address_tfidf, text.address_rich) == [a[1:] for a in ADDRESSES]


def test_white_space_is_pythons(spark):
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert len(odd) == 29
    values = [f"{a}a{a}{b}b{b}" for a in odd for b in odd[::5]] + ["​x​", "İ ΑΣ"]
    want = [v.lower().strip() for v in values]
    assert [r[0] for r in apply(spark, values, text.raw)] == want


@pytest.mark.parametrize("states", [text.US_STATES, text.RICH_INDIA_STATES])
def test_every_state_is_coded(spark, states):
    out = apply(spark, [f"1 main road, {s.upper()}" for s in states], lambda c: text.squeeze(text.alnum_only(text.swap_states(F.lower(c), states))))
    assert [o[0] for o in out] == [f"1 main road {code}" for code in states.values()]
    assert len(text.US_STATES) == 50 and len(text.INDIA_STATES) == 21


def test_lists(spark):
    assert apply(spark, ["a, b ,,c\t", "", None, " "], text.split_ids) == [(["a", "b", "c"],), ([],), ([],), ([],)]
    assert apply(spark, ["the the an cat\tcat dog"], lambda c: F.sort_array(text.tokens(c))) == [(["cat", "dog", "the"],)]


def test_only_other_letters_go_to_python(spark):
    df = spark.createDataFrame([("plain",), ("é",), (None,)], "v string").select(text.transliterate(F.col("v")).alias("t"))
    assert [r.t for r in df.collect()] == ["plain", "e", ""]


def test_romanise():
    assert text.romanise("Ünïted Ça") == "United Ca"
    assert text.romanise("ﬁne ½") .startswith("fine ")
    assert text.romanise("ಕ").isascii() and text.romanise("数").isascii()


def test_jaro_winkler_values():
    jw = similarity.jaro_winkler_one
    assert round(jw("martha", "marhta"), 6) == 0.961111 and round(jw("dixon", "dicksonx"), 6) == 0.813333
    assert jw("", "") == jw("a", "") == jw("abc", "xyz") == 0.0 and jw("same", "same") == 1.0
    assert jw("marlow green co", "mg") == jw("mg", "marlow green co")


def test_jaro_winkler_of_many_pairs_at_once(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé\U0001f600 ") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 30, 47, 48, 49, 90])))
    a = [word() for _ in range(3000)]
    b = [x if (u := rng.random()) < 0.1 else x[:-1] + "zz" if u < 0.5 else x[::-1] if u < 0.6 else word() for x in a]
    want = [similarity.jaro_winkler_one(x, y) for x, y in zip(a, b, strict=True)]
    assert similarity.jaro_winkler_pairs(a, b).tolist() == want and similarity.jaro_winkler_pairs([], []).tolist() == []
    df = spark.createDataFrame(list(zip(range(len(a)), a, b, strict=True)), "i int, a string, b string")
    got = df.select("i", similarity.jaro_winkler(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == want
