"""Pairwise similarities in 0 to 1. An empty side gives 0."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def both(a: Column, b: Column) -> Column:
    return (a != "") & (b != "")


def exact(a: Column, b: Column) -> Column:
    """1 if both are there and equal, else 0."""
    return F.when(both(a, b) & (a == b), 1).otherwise(0)


def levenshtein(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, in code points; native."""
    far = F.levenshtein(a, b).cast("double") / F.greatest(F.length(a), F.length(b))
    return F.when(both(a, b), F.lit(1.0) - far).otherwise(0.0)


def length_difference(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b))


def jaro_winkler_one(a: str, b: str) -> float:
    """Jaro similarity; above 0.7 a common prefix of up to 4 characters adds 0.1 of what lacks for each."""
    if a == b:
        return 1.0 if a else 0.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    taken = [False] * m
    mine = []
    for i, ch in enumerate(a):
        lo, hi = max(0, i - reach), min(m, i + reach + 1)
        j = b.find(ch, lo, hi)
        while j >= 0 and taken[j]:
            j = b.find(ch, j + 1, hi)
        if j >= 0:
            taken[j] = True
            mine.append(ch)
    k = len(mine)
    if not k:
        return 0.0
    theirs = [ch for ch, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (k / n + k / m + (k - swaps) / k) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, n, m) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def _codes(s: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points (row x place, 0 beyond the end) and lengths."""
    n = np.fromiter(map(len, s), np.int64, len(s))
    out = np.zeros((len(s), int(n.max(initial=1))), np.uint32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer("".join(s).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, n


def _jaro_winkler_block(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler_one`` of pairs of unlike, non-empty strings, a place of all first strings at a time."""
    (x, n), (y, m) = _codes(a), _codes(b)
    rows, places = np.arange(len(x)), np.arange(y.shape[1])
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    hit, taken = np.zeros(x.shape, bool), np.zeros(y.shape, bool)
    for i in range(x.shape[1]):
        fits = (y == x[:, i : i + 1]) & ~taken & (np.abs(places - i) <= reach[:, None]) & (places < m[:, None])
        first = fits.argmax(axis=1)
        hit[:, i] = found = fits[rows, first] & (i < n)
        taken[rows[found], first[found]] = True
    k = hit.sum(axis=1)
    # the matched characters of both sides in their order, side by side: row by row they are equally many
    swapped = np.add.reduceat(np.append(x[hit] != y[taken], False), np.minimum(np.cumsum(k) - k, k.sum()), dtype=np.int64) * (k > 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        jaro = np.where(k > 0, (k / n + k / m + (k - swapped // 2) / k) / 3, 0.0)
    width = min(4, x.shape[1], y.shape[1])
    same = (x[:, :width] == y[:, :width]) & (np.arange(width) < np.minimum(n, m)[:, None])
    prefix = same.cumprod(axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


_CELLS = 1 << 22  # compared at once
_LONG = 48  # characters; longer pairs go one by one, where searching is faster than comparing all places


def jaro_winkler_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler_one`` of each pair; pairs of like lengths are taken together."""
    size = np.maximum(np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b)))
    out, order = np.zeros(len(a)), np.argsort(size, kind="stable")
    easy = np.array([x == y or not x or not y for x, y in zip(a, b, strict=True)], bool)
    for i in np.flatnonzero(easy | (size > _LONG)).tolist():
        out[i] = jaro_winkler_one(a[i], b[i])
    order = order[~easy[order] & (size[order] <= _LONG)]
    at = 0
    while at < len(order):
        step = max(1, _CELLS // (4 * int(size[order[at]])))
        step = max(1, min(step, _CELLS // int(size[order[min(at + step, len(order)) - 1]])))
        part = order[at : at + step]
        out[part] = _jaro_winkler_block([a[i] for i in part.tolist()], [b[i] for i in part.tolist()])
        at += step
    return out


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    asked = a.notna()
    out = pd.Series(np.zeros(len(a)), dtype="float64")
    out[asked.to_numpy()] = jaro_winkler_pairs(a[asked].tolist(), b[asked].tolist())
    return out


def jaro_winkler(a: Column, b: Column) -> Column:
    """There is no such function in Spark, so numpy over Arrow batches; of equal and empty sides these hold nulls only."""
    asked = both(a, b) & (a != b)
    return F.when(~both(a, b), 0.0).when(a == b, 1.0).otherwise(_jaro_winkler(F.when(asked, a), F.when(asked, b)))
