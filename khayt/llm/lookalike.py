"""One consistent form of text whose characters only look right.

Text is copied from Arrow to numpy code-point arrays. Lookup tables give every code point its plain form (none, one or several code points); gathers and expansion
offsets build the new text; combining marks are then ordered and composed on whole arrays. No string call is made per row.
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

# Letters of other scripts that look as Latin letters do, in the order of the Latin letters.
LATIN_TWINS = {
    "A": "ΑА", "B": "ΒВ", "C": "СϹ", "E": "ΕЕ", "F": "Ϝ", "G": "Ԍ", "H": "ΗН", "I": "ΙІӀ", "J": "ЈͿ", "K": "ΚК", "L": "Ꮮ", "M": "ΜМ", "N": "Ν", "O": "ΟО", "P": "ΡР", "Q": "Ԛ",
    "S": "ЅՏ", "T": "ΤТ", "U": "Ս", "V": "Ѵ", "W": "Ԝ", "X": "ΧХ", "Y": "ΥҮ", "Z": "Ζ",
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һհ", "i": "іι", "j": "јϳ", "k": "κ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "νѵ",
    "w": "ԝ", "x": "хχ", "y": "уү",
}
# Letters of other alphabets that look as Arabic letters do in one of their shapes. Letters with signs of their own are none.
ARABIC_TWINS = {"ك": "کڪ", "ي": "یېۍ", "ه": "ھہەۿ", "ة": "ۃ", "ى": "ۑ"}
# Visible format characters, and invisible characters that are no format characters.
SHOWN_FORMAT = (0x0600, 0x0601, 0x0602, 0x0603, 0x0604, 0x0605, 0x06DD, 0x070F, 0x0890, 0x0891, 0x08E2, 0x110BD, 0x110CD)
HIDDEN = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))
#: Ligatures that are signs of their own (whole phrases, ornate brackets).
SIGNS = (*range(0xFBB2, 0xFBD3), *range(0xFD3E, 0xFD50), *range(0xFDF0, 0xFE00))
#: Kinds of compatibility forms that show as their plain form does.
SAME_SHAPE = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<isolated>", "<initial>", "<medial>", "<final>", "<compat>")
# Digits that show as a letter does where it stands unjoined, and the letters that do not join the one after them.
DIGIT_LETTERS = {0x0661: 0x0627, 0x0665: 0x0647}
UNJOINED = "اأإآٱدذرزوؤةىء"
#: A word with fewer letters than this is a siglum (of a volume, a page), and the digit on it a number.
WORD_LETTERS = 2

KEEP, FOLD, LATIN, EASTERN = 0, 1, 2, 3  # what the table of kinds says: as it is; replaced always; replaced in text that isn't of that script


@cache
def tables() -> dict[str, np.ndarray]:
    """Lookup tables over all code points, made from the Unicode data of the standard library."""
    n = sys.maxunicode + 1
    kind, width, at, to = np.zeros(n, np.uint8), np.ones(n, np.uint8), np.zeros(n, np.int32), []
    ccc, script, letter = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.zeros(n, bool)
    twins = {ord(x): ord(plain) for plain, all_ in LATIN_TWINS.items() for x in all_}
    arabic = {ord(x): ord(plain) for plain, all_ in ARABIC_TWINS.items() for x in all_}
    pairs = {}

    def fold(c: int, plain: str, what: int = FOLD) -> None:
        kind[c], width[c], at[c] = what, len(plain), len(to)
        to.extend(map(ord, plain))

    for c in cp.ASSIGNED:
        ch = chr(c)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co", "Cs"):
            continue
        ccc[c] = unicodedata.combining(ch)
        if cat[0] == "L":
            letter[c] = True
            name = "" if 0x2E80 <= c < 0xF900 or c >= 0x20000 else unicodedata.name(ch, "")
            script[c] = 1 if name.startswith(("LATIN", "FULLWIDTH LATIN")) else 2 if name.startswith("ARABIC") else 3 if name.startswith(("GREEK", "CYRILLIC", "ARMENIAN")) else 0
        form = unicodedata.decomposition(ch)
        if form and form[0] != "<" and " " in form and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(x, 16) for x in form.split())
            pairs[a << 21 | b] = c
        if c in arabic:
            fold(c, chr(arabic[c]))
        elif 0x06F0 <= c <= 0x06F9:
            fold(c, chr(c - 0x06F0 + 0x0660))
        elif c in twins:
            fold(c, chr(twins[c]), LATIN)
        elif (cat == "Cf" and c not in SHOWN_FORMAT) or c in HIDDEN or (cat == "Cc" and ch not in "\t\n\r"):
            fold(c, "")
        elif cat == "Zs" and c != 0x20:
            fold(c, " ")
        elif c in SIGNS:
            continue
        elif form[:1] == "<" and (tag := form.split(" ", 1)[0]) in SAME_SHAPE and (tag != "<compat>" or cat[0] == "L"):
            fold(c, "".join(chr(arabic.get(ord(x), ord(x))) for x in unicodedata.normalize("NFKC", ch)))
        elif form and unicodedata.normalize("NFC", ch) != ch:
            fold(c, unicodedata.normalize("NFC", ch))
    pairs[0x0649 << 21 | 0x0654] = 0x0626  # a yeh without dots under a hamza shows as the yeh with hamza
    keys = np.array(sorted(pairs), np.int64)
    parts = np.zeros(n, np.int64)
    for k, c in pairs.items():
        if c != 0x0626 or k >> 21 != 0x0649:
            parts[c] = k
    return {
        "kind": kind, "width": width, "at": at, "to": np.array(to, np.uint32), "ccc": ccc, "script": script, "letter": letter, "parts": parts,
        "pair": keys, "composed": np.array([pairs[k] for k in keys.tolist()], np.uint32),
    }


def _gather(points: np.ndarray, starts: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace the code points marked by their expansions."""
    t = tables()
    width = np.where(plain, t["width"][points], 1).astype(np.int64)
    end = np.zeros(len(points) + 1, np.int64)
    np.cumsum(width, out=end[1:])
    source = np.repeat(np.arange(len(points)), width)
    within = np.arange(end[-1]) - end[source]
    out = points[source]
    swap = plain[source]
    out[swap] = t["to"][t["at"][out[swap]] + within[swap]]
    return out, end[starts]


def _compose(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks in canonical order and composed with their letters; the last array says for each row whether anything was composed."""
    t = tables()
    ccc = t["ccc"][points]
    made = np.zeros(len(starts) - 1, bool)
    if not ccc.any():
        return points, starts, made
    # A composed letter is taken apart if a mark on it comes before its own in canonical order and composes with the bare letter.
    heads = np.zeros(len(points) + 1, bool)
    heads[starts] = True
    letter = np.maximum.accumulate(np.where((ccc == 0) | heads[:-1], np.arange(len(points)), -1))
    mark = np.flatnonzero((ccc > 0) & ~heads[:-1])
    mark = mark[t["parts"][points[letter[mark]]] > 0]
    if len(mark):
        parts = t["parts"][points[letter[mark]]]
        key = parts >> 21 << 21 | points[mark]
        where = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
        own = np.unique(letter[mark][(t["pair"][where] == key) & (ccc[mark] < t["ccc"][parts & 0x1FFFFF])])
        if len(own):
            parts = t["parts"][points[own]]
            points = np.insert(points, own + 1, (parts & 0x1FFFFF).astype(np.uint32))
            points[own + np.arange(len(own))] = (parts >> 21).astype(np.uint32)
            starts = starts + np.searchsorted(own, starts)
            ccc = t["ccc"][points]
    first = np.zeros(len(points), bool)
    first[starts[:-1][starts[:-1] < len(points)]] = True
    cluster = np.cumsum((ccc == 0) | first)
    order = np.lexsort((ccc, cluster))
    points, ccc = points[order], ccc[order]
    row = cp.rows_of(starts)
    keep = np.ones(len(points), bool)
    while True:
        live = np.flatnonzero(keep)
        c, k = points[live], ccc[live]
        prior = np.maximum.accumulate(np.where(k == 0, np.arange(len(live)), -1))  # the letter before a mark
        mark = np.flatnonzero((k > 0) & (prior >= 0))
        mark = mark[row[live[mark]] == row[live[prior[mark]]]]
        open_ = (mark - 1 == prior[mark]) | (k[mark - 1] < k[mark])
        mark = mark[open_]
        key = c[prior[mark]].astype(np.int64) << 21 | c[mark]
        where = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
        hit = t["pair"][where] == key
        mark, where = mark[hit], where[hit]
        if not len(mark):
            break
        base, once = np.unique(prior[mark], return_index=True)
        points[live[base]] = t["composed"][where[once]]
        keep[live[mark[once]]] = False
        made[row[live[base]]] = True
    left = np.zeros(len(points) + 1, np.int64)
    np.cumsum(keep, out=left[1:])
    return points[keep], left[starts], made


def _digits(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A lone digit in a word of Arabic letters stands for a letter where that letter would show the same; which rows had one.

    That is after a letter that does not join, or at the start of the word (only alif), and with no letter after it that heh would join. Digits on words of fewer than WORD_LETTERS
    letters, after a joining letter (a footnote's number), next to other digits, and an alif that would end a word after another alif, are numbers.
    """
    t = tables()
    rows = np.zeros(len(starts) - 1, bool)
    digit = np.flatnonzero((points == 0x0661) | (points == 0x0665))
    if not len(digit):
        return points, rows
    row = cp.rows_of(starts)
    letter, mark = t["script"][points] == 2, t["ccc"][points] > 0
    number = (points >= 0x0660) & (points <= 0x0669)
    part = letter | mark | number
    joined = part[1:] & part[:-1] & (row[1:] == row[:-1])
    word = np.concatenate([[0], np.cumsum(~joined)])
    letters = np.bincount(word, letter)
    bare = np.flatnonzero(~mark)  # neighbours are looked for beyond the marks on a letter
    place = np.searchsorted(bare, digit)
    before, after = bare[np.maximum(place - 1, 0)], bare[np.minimum(place + 1, len(bare) - 1)]
    has_b, has_a = (place > 0) & (word[before] == word[digit]), (place < len(bare) - 1) & (word[after] == word[digit])
    free = ~has_b | np.isin(points[before], np.array([ord(c) for c in UNJOINED], np.uint32))
    alif = points[digit] == 0x0661
    may = np.where(alif, has_a | (has_b & (points[before] != 0x0627)), has_b & ~has_a)
    digit = digit[may & free & ~(has_b & number[before]) & ~(has_a & number[after]) & (letters[word[digit]] >= WORD_LETTERS)]
    points = points.copy()
    points[digit] = np.where(points[digit] == 0x0661, DIGIT_LETTERS[0x0661], DIGIT_LETTERS[0x0665])
    rows[row[digit]] = True
    return points, rows


def plain_points(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, row starts, changed): the plain form of every row, and which rows held what shows as something plainer or not at all."""
    t = tables()
    kind, script, row = t["kind"][points], t["script"][points], cp.rows_of(starts)
    size = len(starts) - 1
    latin, eastern = (np.bincount(row[script == s], minlength=size) for s in (1, 3))
    twins = np.bincount(row[kind == LATIN], minlength=size)
    # Letters of Greek, Cyrillic or Armenian shape are Latin unless the text is written in such a script: then it has letters that have no Latin twin.
    own = (eastern - twins > 0) & (eastern > latin)
    plain = (kind == FOLD) | ((kind == LATIN) & ~own[row])
    changed = cp.any_in_row(plain, starts)
    points, starts = _gather(points, starts, plain)
    while True:  # a digit that became a letter may compose with its marks, which may bring letters to other digits
        points, starts, made = _compose(points, starts)
        points, hit = _digits(points, starts)
        changed |= made | hit
        if not hit.any():
            return points, starts, changed


def plain_array(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The plain form of an Arrow array of text, and the mask of the rows that were not plain. Null stays null, empty stays empty."""
    array = cp.column(array)
    nulls = array.is_null().to_numpy(zero_copy_only=False)
    texts, masks = [], []
    for a, b in cp.pieces(array):
        points, starts, changed = plain_points(*cp.explode(array.slice(a, b - a)))
        texts.append(cp.implode(points, starts, nulls[a:b]))
        masks.append(changed)
    if not texts:
        return array, np.zeros(0, bool)
    return pa.concat_arrays(texts), np.concatenate(masks)


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, changed = plain_array(batch.column("_text"))
        keep = [batch.column(i).cast(f.type) for i, f in enumerate(batch.schema) if f.name != "_text"]
        names = [f.name for f in batch.schema if f.name != "_text"]
        yield pa.RecordBatch.from_arrays([*keep, text.cast(pa.string()), pa.array(changed)], names=[*names, "_plain", "_odd"])


def plain_text(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``plain`` (the consistent form of the text) and ``odd`` (whether the text was not in it), one row for each row of df.

    A null text gives a null and is not odd; an empty one stays empty; a very long one is worked on whole. A text is odd if it holds a compatibility form or look-alike of a
    plainer character, a space other than U+0020, a character that does not show, a digit as a letter (see ``_digits``), or a letter and mark that compose. Marks are
    put in canonical order, which alone makes no text odd. The form is a fixed point: plain text stays as it is. Columns that are not named are not read; names may clash with ours.
    """
    named = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    src = df.select(*named, F.col(text).alias("_text"))
    schema = ", ".join([f"c{i} {src.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))] + ["_plain string", "_odd boolean"])
    out = src.mapInArrow(_work, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_plain").alias("plain"), F.col("_odd").alias("odd"))
