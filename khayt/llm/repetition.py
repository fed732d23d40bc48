"""Repetition inside one document, by line-first cleaning: lines first, then the document.

A text is cut into lines at line ends and sentence ends, and where a passage of consecutive words that stood earlier in the text begins and ends. Each line is judged by rules: it
fails if it is mostly signs (punctuation) or says nothing, if it is navigation (few words between separators), if it holds a phrase of boilerplate, or if it is such a repeated passage.
Failed lines are removed, and a document that loses too much of its text, counted in words, is rejected. All is done on code-point arrays of whole batches; texts are whole,
whatever their length.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khayt.llm import codepoints as cp

WINDOW = 5
REJECT_SHARE = 0.25
#: A line with at least so many separators and at most so many words to each is navigation.
SEPARATORS, NAV_SEPARATORS, NAV_WORDS = "|›»•·→", 2, 3
#: A line of which more than this share of the characters that show are neither letters, marks nor digits is mostly signs.
SIGN_SHARE = 0.5
# Line ends, blanks, and signs that end a sentence if a blank follows.
LINE_ENDS, BLANKS, STOPS = "\n\r\x0b\x0c\x85\u2028\u2029", "\t \xa0", ".!?؟۔。"
# Phrases of boilerplate, as words in lower case without marks.
BOILERPLATE = (
    "all rights reserved", "click here", "privacy policy", "terms of use", "terms of service", "cookie policy", "uses cookies", "enable javascript", "skip to content", "back to top", "read more",
    "sign up for", "subscribe to our", "powered by", "lorem ipsum", "page not found",
    "جميع الحقوق محفوظة", "اضغط هنا", "سياسة الخصوصية", "شروط الاستخدام", "اقرأ المزيد", "العودة إلى الأعلى", "الصفحة الرئيسية", "تمامی حقوق محفوظ است", "کلیک کنید", "ادامه مطلب",
)
_BARS, _ENDS, _BLANKS, _STOPS = (np.array([ord(c) for c in x], np.uint32) for x in (SEPARATORS, LINE_ENDS, BLANKS, STOPS))
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: 0 other, 1 letter, 2 combining mark, 3 number; and a random value of its lower case."""
    n = sys.maxunicode + 1
    kind, low = np.zeros(n, np.uint8), np.arange(n, dtype=np.uint32)
    for c in cp.ASSIGNED:
        cat = unicodedata.category(chr(c))[0]
        if cat == "L":
            kind[c], low[c] = 1, ord(chr(c).lower()[0])
        elif cat in "MN":
            kind[c] = 2 if cat == "M" else 3
    value = np.random.default_rng(7).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    return kind, value[low]


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def words(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first code point) of each word: runs of letters in lower case, without combining marks."""
    kind, value = _tables()
    k = kind[points]
    seen = np.flatnonzero(k != 2)  # marks are gone before words are formed
    c, row = points[seen], cp.rows_of(starts)[seen]
    letter = k[seen] == 1
    before = np.zeros(len(seen), bool)
    before[1:] = letter[:-1] & (row[1:] == row[:-1])
    head = letter & ~before
    at = np.flatnonzero(head)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.cumsum(head) - 1
    place = np.arange(len(seen)) - at[np.maximum(word, 0)]
    length = int(place[letter].max()) + 1
    part = np.where(letter, value[c] * _powers(length, _MIX)[np.minimum(np.maximum(place, 0), length - 1)], np.uint64(0))
    h = np.add.reduceat(part, at)
    return h ^ (h >> np.uint64(29)), row[at], seen[at]


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive words."""
    n = max(0, len(h) - width + 1)
    gram = np.zeros(n, np.uint64)
    for i in range(width):
        gram = gram * _STEP + h[i : i + n] * _MIX
    return gram


def repeated(h: np.ndarray, row: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Mask of the words that lie in ``window`` consecutive words which stood in the same order starting earlier in the same row."""
    n = len(h) - window + 1
    out = np.zeros(len(h), bool)
    if n <= 0:
        return out
    gram = _grams(h, window)
    whole = np.flatnonzero(row[:n] == row[window - 1 :])
    key = (gram[whole] ^ (gram[whole] >> np.uint64(31))) * _STEP + row[whole].astype(np.uint64) * _MIX
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(whole), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    change = np.zeros(len(h) + 1, np.int64)
    np.add.at(change, whole[same], 1)
    np.add.at(change, whole[same] + window, -1)
    return np.cumsum(change[:-1]) > 0


@cache
def _phrases() -> dict[int, np.ndarray]:
    """Per number of words, the hashes of the phrases of boilerplate with so many."""
    out: dict[int, list[np.ndarray]] = {}
    for phrase in BOILERPLATE:
        h, _, _ = words(*cp.explode(cp.column(pa.array([phrase]))))
        out.setdefault(len(h), []).append(_grams(h, len(h)))
    return {n: np.concatenate(g) for n, g in out.items()}


def judge(array: pa.Array, window: int = WINDOW, clean: bool = True) -> dict[str, object]:
    """Per row of an Arrow array: words, repeated words, words lost with what fails, lines with anything in them, lines that fail, and (if asked for) the text without what fails."""
    array = cp.column(array)
    nulls = array.is_null().to_numpy(zero_copy_only=False)
    names = ("words", "repeated", "lost", "lines", "failed")
    got: dict[str, list] = {k: [] for k in (*names, "text")}
    kind = _tables()[0]
    for a, b in cp.pieces(array):
        points, starts = cp.explode(array.slice(a, b - a))
        size = b - a
        h, row, at = words(points, starts)
        rep = repeated(h, row, window)
        # Lines: one more begins with each row, after each line end, and after a blank that ends a sentence.
        end, blank = np.isin(points, _ENDS), np.isin(points, _BLANKS)
        opens = np.zeros(len(points), bool)
        opens[1:] = end[:-1]
        opens[2:] |= blank[1:-1] & np.isin(points[:-2], _STOPS)
        opens[starts[:-1][starts[:-1] < len(points)]] = True
        heads = np.flatnonzero(opens)
        line = np.cumsum(opens) - 1
        n = len(heads)
        shows = (points > 32) & ~end & ~blank
        count = lambda mask: np.bincount(line[mask], minlength=n)  # noqa: B023, E731
        shown, of = count(shows), line[at]
        said, again = np.bincount(of, minlength=n), np.bincount(of[rep], minlength=n)
        bars = count(np.isin(points, _BARS))
        punctuation = (said == 0) | (count(shows & (kind[points] == 0)) > SIGN_SHARE * shown)
        navigation = (bars >= NAV_SEPARATORS) & (said <= NAV_WORDS * (bars + 1))
        boilerplate = np.zeros(n, bool)
        for m, phrases in _phrases().items():
            hit = np.flatnonzero(np.isin(_grams(h, m), phrases))
            boilerplate[of[hit[of[hit] == of[hit + m - 1]]]] = True
        fails = (shown > 0) & (punctuation | navigation | boilerplate | ((said > 0) & (again == said)))
        lost = rep | fails[of]
        got["words"].append(np.bincount(row, minlength=size))
        got["repeated"].append(np.bincount(row[rep], minlength=size))
        got["lost"].append(np.bincount(row[lost], minlength=size))
        home = cp.rows_of(starts)[heads]
        got["lines"].append(np.bincount(home[shown > 0], minlength=size))
        got["failed"].append(np.bincount(home[fails], minlength=size))
        if clean:
            keep = ~fails[line] if n else np.zeros(0, bool)
            if rep.any():  # a repeated passage within a line goes up to the next word or the end of the line
                begun = np.zeros(len(points), np.int64)
                begun[at] = 1
                word = np.cumsum(begun) - 1
                keep &= ~((word >= 0) & rep[word] & (of[word] == line) & ~end)
            left = np.zeros(len(points) + 1, np.int64)
            np.cumsum(keep, out=left[1:])
            got["text"].append(cp.implode(points[keep], left[starts], nulls[a:b]))
    out: dict[str, object] = {k: np.concatenate(got[k]) if got[k] else np.zeros(0, np.int64) for k in names}
    out["text"] = pa.concat_arrays(got["text"]) if got["text"] else pa.array([], pa.large_string())
    return out


def repetition(df: DataFrame, key: str, text: str, reject_share: float = REJECT_SHARE, window: int = WINDOW, clean: bool = True) -> DataFrame:
    """(key, words, repeated, share, lines, failed_lines, lost, rejected, kept), one row for each row of df.

    repeated: words in passages that are removed because they stood earlier; share is these by all words, 0 where there are no words (null, empty and blank texts, digits only).
    lost: words removed by any rule. rejected: at least ``reject_share`` of the words are lost. As all repeated words are lost, each text with such a share of them is rejected.
    kept is the text without what failed (null for a null text, or if ``clean`` is off). Texts with fewer than ``window`` words repeat nothing.
    Repeated keys keep their rows. Columns that are not named are not read.
    """
    counts = ("words", "repeated", "lines", "failed", "lost")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = judge(batch.column(1), window, clean)
            kept = got["text"].cast(pa.string()) if clean else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(got[k], pa.int64()) for k in counts], kept], names=["k", *counts, "kept"])

    src = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = src.mapInArrow(work, f"k {src.schema['k'].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in counts)}, kept string")
    share = F.when(F.col("words") > 0, F.col("repeated") / F.col("words")).otherwise(F.lit(0.0))
    return out.select(
        F.col("k").alias(key), "words", "repeated", share.alias("share"), "lines", F.col("failed").alias("failed_lines"), "lost",
        ((F.col("words") > 0) & (F.col("lost") >= F.col("words") * F.lit(reject_share))).alias("rejected"), "kept",
    )
