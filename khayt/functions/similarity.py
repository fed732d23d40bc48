"""String similarities that have no built-in: normalised indel ratio and token-set ratio, in Arrow batches over distinct pairs."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per letter of b (bit-parallel)."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        m = v & where.get(c, 0)
        v = ((v + m) | (v - m)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * lcs / (length of both), 100 for two empty strings."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs(a, b) / total


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row a text, filled up with 0, and the lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), max(1, int(size.max(initial=0)))), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out, size


def ratios(left: list[str], right: list[str], together: int = 16384) -> np.ndarray:
    """``ratio`` of every text of one list with every one of the other: the same bits as in ``lcs``, for many pairs in one array operation."""
    out = np.empty((len(left), len(right)))
    if not out.size:
        return out
    a, n = _letters(left)
    b, m = _letters(right)
    by = np.argsort(-m, kind="stable")
    known, codes = np.unique(b[by], return_inverse=True)
    b, m = np.ascontiguousarray(codes.reshape(b.shape).T), m[by]
    long = np.searchsorted(-m, -np.arange(len(b)))  # how many texts have more letters than so many
    fit = np.flatnonzero(n <= 64)
    step = max(1, together // max(1, len(right)))
    for at in range(0, len(fit), step):
        own = fit[at : at + step]
        where = np.zeros((len(own), len(known)), np.uint64)
        for i in range(int(n[own].max())):
            k = np.searchsorted(known, a[own, i]).clip(max=len(known) - 1)
            has = np.flatnonzero((i < n[own]) & (known[k] == a[own, i]))
            where[has, k[has]] |= np.uint64(1 << i)
        v = np.full((len(own), len(right)), ~np.uint64(0))
        for j in range(len(b)):
            u = v[:, : long[j]]
            x = u & np.take(where, b[j, : long[j]], axis=1)
            u[:] = (u + x) | (u - x)
        same = np.bitwise_count(~v & ~np.uint64(0) >> (64 - n[own]).clip(max=63).astype(np.uint64)[:, None]) * (n[own] > 0)[:, None]
        total = n[own, None] + m
        out[own[:, None], by] = np.where(total, 200.0 * same / np.maximum(total, 1), 100.0)
    for i in np.flatnonzero(n > 64):
        out[i] = [ratio(left[i], t) for t in right]
    return out


@lru_cache(1 << 16)
def _tokens(text: str) -> frozenset[str]:
    return frozenset(text.split())


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared tokens and each side's shared and own tokens, all sorted; 100 if one side's tokens are all shared, 0 if a side is empty."""
    x, y = _tokens(a), _tokens(b)
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    s, l, r = " ".join(both), " ".join(left), " ".join(right)
    one, two = (f"{s} {l}".strip(), f"{s} {r}".strip())
    best = ratio(one, two)
    return max(best, ratio(s, one), ratio(s, two)) if s else best


#: Distinct words of a name up to which its pairs are sifted, and counters of letters; letters that share one only loosen the bound.
WORDS, COUNTERS = 12, 32


def sifted(names: list[str], x: np.ndarray, y: np.ndarray, least: float, together: int = 16384) -> np.ndarray:
    """Of pairs of numbers of names those, as a mask, whose ``token_set_ratio`` may reach ``least``: never left out if it does.

    Of words that both have nothing is lost; of the others no more letters can be common than both have of each.
    """
    words = [sorted(_tokens(t)) for t in names]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
    size = np.array([*map(len, number), 0], np.int64)
    held = np.zeros((len(size), COUNTERS), np.int16)
    letters, long = _letters([*number])
    at = np.repeat(np.arange(len(number)), long)
    np.add.at(held, (at, letters[np.arange(letters.shape[1]) < long[:, None]] % COUNTERS), 1)
    count = np.array([len(ws) for ws in words], np.int64)
    of = np.full((len(names), WORDS), -1)
    for i, ws in enumerate(words):
        if len(ws) <= WORDS:
            of[i, : len(ws)] = [number[w] for w in ws]
    out = np.zeros(len(x), bool)
    for start in range(0, len(x), together):
        i, j = x[start : start + together], y[start : start + together]
        wide = (count[i] > WORDS) | (count[j] > WORDS)
        k, m = int(count[i].clip(max=WORDS).max(initial=1)), int(count[j].clip(max=WORDS).max(initial=1))
        a, b = of[i, :k], of[j, :m]
        same = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]
        own_a, own_b, shared = (a >= 0) & ~same.any(2), (b >= 0) & ~same.any(1), same.any(2)
        n_a, n_b, n = own_a.sum(1), own_b.sum(1), shared.sum(1)
        chars = lambda w, mask, c: (size[w] * mask).sum(1) + (c - 1).clip(min=0)
        s, left, right = chars(a, shared, n), chars(a, own_a, n_a), chars(b, own_b, n_b)
        has_a, has_b = np.zeros((len(i), COUNTERS), np.int16), np.zeros((len(i), COUNTERS), np.int16)
        for w, mask, has in ((a, own_a, has_a), (b, own_b, has_b)):
            for c in range(w.shape[1]):
                rows = np.flatnonzero(mask[:, c])
                has[rows] += held[w[rows, c]]
        most = np.minimum(has_a, has_b).sum(1) + np.minimum((n_a - 1).clip(min=0), (n_b - 1).clip(min=0))
        both = np.where(n > 0, s + 1, 0)
        best = (both + most) * 200.0 / np.maximum(1, 2 * both + left + right)
        for rest in (left, right):
            best = np.maximum(best, np.where(n > 0, 200.0 * s / np.maximum(1, 2 * s + 1 + rest), 0))
        out[start : start + together] = wide | (n > 0) & ((n_a == 0) | (n_b == 0)) | (best >= least - 1e-6)
    return out


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def token_set_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
