"""Text normalisation as native column expressions.

Profiles: ``name_token`` (blocking on tokens), ``name_tfidf`` and
``address_tfidf`` (retrieval by cosine), ``name_rich`` and ``address_rich``
(transliterated, with suffix and address rules), ``raw`` (pair features) and
``country``. Null counts as the empty string everywhere. White space is what
Python's str calls white space, spelled out, as Java's \\s is narrower.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: the inside of a character class: the 29 white-space code points
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# ---- fixed values: words and codes that normalised texts must have ----

LEGAL_WORDS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company", "llc": "llc", "llp": "llp", "intl": "international",
    "assoc": "associates", "grp": "group", "mgmt": "management", "svcs": "services", "pte": "private", "mfg": "manufacturing", "svc": "service", "sol": "solutions",
}
RICH_LEGAL_WORDS = LEGAL_WORDS | {"plc": "plc", "gmbh": "gmbh", "tech": "technology", "dba": "dba", "ta": "dba"}
RICH_LEGAL_SPELLINGS = {r"\bp\.v\.t\b": "private", r"\bl\.t\.d\b": "limited", r"\bt/a\b": "dba"}
ADDRESS_WORDS = {
    "str": "street", "ave": "avenue", "blvd": "boulevard", "cir": "circle", "hwy": "highway", "fwy": "freeway", "pkwy": "parkway", "flr": "floor",
    "apt": "apartment", "ste": "suite", "bldg": "building",
}
ADDRESS_NOISE = ("near", "opp", "behind", "adjacent", "pincode", "pin code", "po box", r"p\.o\. box")
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de", "florida": "fl",
    "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me",
    "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv",
    "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut",
    "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
INDIA_STATES = {
    "andhra pradesh": "ap", "assam": "as", "bihar": "br", "chhattisgarh": "cg", "delhi": "dl", "gujarat": "gj", "haryana": "hr", "himachal pradesh": "hp", "jharkhand": "jh",
    "karnataka": "ka", "kerala": "kl", "madhya pradesh": "mp", "maharashtra": "mh", "odisha": "od", "punjab": "pb", "rajasthan": "rj", "tamil nadu": "tn",
    "telangana": "tg", "uttar pradesh": "up", "uttarakhand": "uk", "west bengal": "wb",
}
RICH_INDIA_STATES = INDIA_STATES | {"goa": "ga"}

# ---- pieces ----


def once(columns: dict[str, Column]) -> Column:
    """For select(): the columns, evaluated once a row, whatever filters and expressions use them later.

    The optimizer copies expressions into each filter that mentions them; it
    does not reach into a generator (of one row, here).
    """
    return F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """White space off both ends (trim() knows blanks only)."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def squeeze(c: Column) -> Column:
    """Runs of two or more white-space characters become one blank; a single tab or line end stays."""
    return strip(F.regexp_replace(c, f"[{WS}]{{2,}}", " "))


def alnum_only(c: Column) -> Column:
    return F.regexp_replace(c, f"[^a-z0-9{WS}]", " ")


def swap_words(c: Column, words: dict[str, str]) -> Column:
    """Whole words for words; one look tells the rows that have none of them."""
    changed = {k: v for k, v in words.items() if k != v}
    swapped = reduce(lambda x, k: F.regexp_replace(x, rf"\b{k}\b", changed[k]), changed, c)
    return F.when(c.rlike(rf"\b(?:{'|'.join(changed)})\b"), swapped).otherwise(c)


def swap_states(c: Column, states: dict[str, str]) -> Column:
    """State names (one blank between their words) for codes where no letter is beside them; longer names first."""
    names = sorted(states, key=len, reverse=True)
    swapped = reduce(lambda x, k: F.regexp_replace(x, rf"(?<![a-z]){k}(?![a-z])", states[k]), names, c)
    return F.when(c.rlike("|".join(names)), swapped).otherwise(c)


def tokens(c: Column, least: int = 3) -> Column:
    """Distinct words of ``least`` characters or more."""
    return F.array_distinct(F.filter(F.split(c, f"[{WS}]+"), lambda w: F.length(w) >= least))


def split_ids(c: Column) -> Column:
    """A comma list as an array; blanks around ids go, empty ids too."""
    return F.filter(F.transform(F.split(text(c), ","), strip), lambda x: x != "")


def join_ids(c: Column) -> Column:
    return F.array_join(c, ",")


# ---- profiles ----


def name_token(c: Column) -> Column:
    """Lower case, letters a-z and digits; nothing is expanded."""
    return squeeze(alnum_only(F.lower(text(c))))


def name_tfidf(c: Column) -> Column:
    """As ``name_token``, with legal words written out."""
    return squeeze(swap_words(alnum_only(F.lower(text(c))), LEGAL_WORDS))


def address_tfidf(c: Column) -> Column:
    """PO boxes (with the word after) go, state names become codes."""
    po_box = rf"(?U)p\.?[{WS}]*o\.?[{WS}]*box[{WS}]*[\d\w\-]*"
    no_box = F.regexp_replace(F.lower(text(c)), po_box, "")
    return squeeze(alnum_only(swap_states(swap_states(no_box, US_STATES), INDIA_STATES)))


def country(c: Column) -> Column:
    return F.lower(strip(text(c)))


def raw(c: Column) -> Column:
    """Lower case without white space at the ends: what pair features compare."""
    return strip(F.lower(text(c)))


def combined(name: Column, address: Column) -> Column:
    return F.trim(F.concat_ws(" ", name, address))


def romanise(s: str) -> str:
    """ASCII for any text: with the unidecode package if there is one, else accents go and letters are spelled by their Unicode names."""
    s = unicodedata.normalize("NFKC", s)
    if s.isascii():
        return s
    try:
        from unidecode import unidecode

        return unidecode(s)
    except ImportError:
        out = []
        for ch in unicodedata.normalize("NFKD", s):
            if ch.isascii():
                out.append(ch)
            elif not unicodedata.combining(ch) and ch.isalnum():
                last = unicodedata.name(ch, "").split(" ")[-1].lower()
                out.append(last if "LETTER" in unicodedata.name(ch, "") or ch.isdigit() else "")
            elif "VOWEL SIGN" in unicodedata.name(ch, ""):
                out.append(unicodedata.name(ch).split(" ")[-1].lower())
            elif unicodedata.category(ch) in ("Zs", "Pd", "Po"):
                out.append(" ")
        return "".join(out)


@F.pandas_udf(StringType())
def _romanise(s: pd.Series) -> pd.Series:
    return s.map(romanise, na_action="ignore")


def transliterate(c: Column) -> Column:
    """ASCII text; of rows that are ASCII already Python gets a null."""
    x = text(c)
    plain = F.octet_length(x) == F.char_length(x)
    return F.when(plain, x).otherwise(_romanise(F.when(~plain, x)))


def name_rich(c: Column) -> Column:
    """Transliterated, brackets off, legal words and spellings written out."""
    x = F.regexp_replace(F.lower(transliterate(c)), r"[\[\](){}<>]", " ")
    x = reduce(lambda y, k: F.regexp_replace(y, k, RICH_LEGAL_SPELLINGS[k]), RICH_LEGAL_SPELLINGS, x)
    return squeeze(alnum_only(swap_words(x, RICH_LEGAL_WORDS)))


def address_rich(c: Column) -> Column:
    """Transliterated; numbered PO boxes and noise words go, street words are written out, states become codes."""
    x = F.regexp_replace(F.lower(transliterate(c)), rf"p\.?[{WS}]*o\.?[{WS}]*box[{WS}]*\d+", "")
    x = swap_words(x, {k: f" {v} " for k, v in ADDRESS_WORDS.items()})
    x = F.regexp_replace(x, rf"\bno\.[{WS}]*([\d\-]+)", " number $1 ")
    x = reduce(lambda y, k: F.regexp_replace(y, rf"\b{k}\b", " "), ADDRESS_NOISE, x)
    return squeeze(alnum_only(swap_states(swap_states(x, US_STATES), RICH_INDIA_STATES)))


