"""Markup residue: which texts hold it, and clean text that keeps headings, lists, tables, code and formulas.

HTML is read as a stream of events of the standard library's parser; wiki, Markdown and LaTeX by patterns on what is between. Every sign of markup is a span of the source, from
which each line has its ratio of text to tags. How far the ratios fall below those of bare text is smoothed by a Gaussian and cut by a threshold between its two clusters, which
gives the regions of markup: a text holds markup if it has such a region, and regions that are mostly tags (menus and templates) are told from content. All texts
go this way, whatever their length. A sign that serves as ordinary punctuation (a comparison, price, editor's bracket, footnote star) makes no span.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and of the tagged corpora.
ELEMENTS = frozenset(
    """a abbr acronym address applet area article aside audio b base basefont bdi bdo big blink blockquote body br button canvas caption center cite code col colgroup data datalist dd del
 details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html i iframe img input ins kbd label legend li link
 main map mark marquee menu meta meter nav nobr noframes noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section select slot small source span
 strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr xml
 hadith isnad matn nar nowiki ref references sanad math poem gallery onlyinclude noinclude includeonly""".split()
)
# Elements that open a line, and elements whose content is no text.
BLOCKS = frozenset("address article aside blockquote body center div dl dt dd fieldset figure footer form header hr main nav p pre section table tbody thead tfoot tr ul ol li title sanad matn hadith isnad".split())
SILENT = frozenset("script style head template".split())

_TAG_CUT = re.compile(r"<(?:/?[A-Za-z][A-Za-z0-9:-]*(?:\s[^<>]*)?|!(?:-(?:-[^<>]*)?)?|/)$")
_FIRST_EDGE = re.compile(r"[<>\n]")
_ENTITY = re.compile(r"&(?:#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6})|[A-Za-z][A-Za-z0-9]{1,31});")
_ENTITY_CUT = re.compile(r"&(?:#(?:[0-9]{2,7}|[xX][0-9A-Fa-f]{1,6})|(?:nbsp|quot|amp|rlm|lrm|mdash|ndash|zwnj|zwj|apos|hellip|laquo|raquo|ldquo|rdquo|lsquo|rsquo|gt|lt))$")

_CODE = re.compile(r"(?ms)^[ \t]*(?:```|~~~)[^\n]*\n?.*?(?:^[ \t]*(?:```|~~~)[ \t]*$|\Z)|(?<![`\w])(`{1,2})(?![`\s])[^`\n]+?\1(?!`)")
#: Bounded by what closes a formula, not by length; each part is scanned once.
_FORMULA = re.compile(
    r"\\\(.*?(?:\\\)|\Z)|\\\[.*?(?:\\\]|\Z)|\$\$[^$]++\$\$|\$(?=[^$\n]*+(?:\$|\Z))(?=[^$\n\\]*+(?:\\(?![A-Za-z])[^$\n\\]*+)*+\\[A-Za-z])[^$\n]*+(?:\$|\Z)", re.S
)
#: Patterns of markup beside HTML: (name, pattern). Order matters only for cleaning.
RULES = tuple(
    (name, re.compile(pattern))
    for name, pattern in (
        ("template", r"\{\{[^{}\n]*(?:\}\}|$)|\}\}"),
        ("wiki table", r"(?m)^\{\|[^\n]*$|^\|\}[ \t]*$|^\|[-+][^\n|]*$|(?<=\S )\|\|(?= \S)"),
        ("wiki link", r"\[\[|\]\]"),
        ("wiki mark", r"(?<![\w'])'{2,5}(?=[^\s'])[^'\n]*(?:'[^'\n]+)*?'{2,5}(?!')|(?<![\w'])'{2,5}(?=[^\s'])[^'\n]*$"),
        ("outer link", r"\[(?:https?|ftp)://[^\s\]]*(?:[^\]\n]*\])?"),
        ("link", r"!?\[[^\[\]\n]+\]\((?:[a-z]+:|/|#|\.|www\.)?[^()\s]*\)|!?\[[^\[\]\n]+\]\((?:https?:)?[^()\s]*$"),
        ("heading", r"(?m)^ {0,3}#{1,6}[ \t]+\S[^\n]*$|^={1,6}[ \t]*[^=\s][^\n]*?={1,6}[ \t]*$|^={2,6} [^=\n]+\Z|(?<=\S\n)(?:={3,}|-{3,})[ \t]*$"),
        ("rule", r"(?m)^ {0,3}(?:-{4,}|\*{3,}|_{3,}|(?:[-*_] ){2,}[-*_])[ \t]*$"),
        ("fence", r"(?m)^[ \t]*(?:```|~~~)[^\n]*$"),
        ("table", r"(?m)^\|[^\n]*\|[ \t]*$|^[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+$"),
        ("list", r"(?m)^ {0,8}[-*+][ \t]+(?=\S)(?=[^\n]*\S)|^ {0,3}[0-9]{1,3}[.)][ \t]+(?=\S)"),
        ("quote", r"(?m)^ {0,3}>(?:[ \t]|$)"),
        ("bold", r"(?<![\w*])\*\*(?=[^\s*])[^*\n]*[^\s*]\*\*(?!\w)|(?<![\w_])__(?=[^\s_])[^_\n]*[^\s_]__(?!\w)|(?<![\w*])\*\*(?=[^\s*])[^*\n]*$"),
        ("emphasis", r"(?<![\w*])\*(?=[^\s*])[^*\n]*?[^\s*]\*(?![\w*])|(?<![\w*])\*[^\s*]\*(?![\w*])|(?<![\w_])_(?=[^\s_])[^_\n]*?[^\s_]_(?![\w_])|(?<![\w_])_[^\s_]_(?![\w_])"),
        ("struck", r"~~(?=\S)[^~\n]+~~"),
        ("command", r"\\(?:begin|end)\{[A-Za-z]*\*?\}?|\\[A-Za-z]{2,}\*?(?:\[[^\]\n]*\])?|\\[()\[\]](?=[^\n])"),
    )
)
#: An ampersand escaped several times over.
_AMPS = re.compile(r"&(?:amp;)+(?=#?\w+;)")
_LIST_LINES = re.compile(r"(?m)^ {0,3}([0-9]{1,3})[.)][ \t]+\S")


#: Texts that match none of this have no markup; only the others are looked at closely.
MAY_HOLD = r"[<&\[\]{}|\\`$~]|''|\*\S|__?\S|(?m:^ {0,8}(?:[-*+>=#]|[0-9]{1,3}[.)]))|(?m:^(?:={3,}|-{3,}|_{3,}))|\A[^<>\n]*>"
_MAY_HOLD = re.compile(MAY_HOLD)


class _Events(HTMLParser):
    """Collects (start, end, kind, name) of the tags, comments and references, and the clean text between them."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=False)
        self.text, self.spans, self.out, self.silent, self.cells = text, [], [], 0, 0
        self.lines = [0, *(m.end() for m in re.finditer("\n", text))]
        self.closes = {n.lower() for n in re.findall(r"</([A-Za-z][A-Za-z0-9:-]*)\s*>", text)}
        self.feed(text)
        self.close()

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _known(self, tag: str, raw: str) -> bool:
        return tag in ELEMENTS or tag in self.closes or "=" in raw or raw.endswith("/>") or ":" in tag

    def _put(self, text: str) -> None:
        if not self.silent:
            self.out.append(text)

    def _line(self) -> None:
        if self.out and not "".join(self.out[-3:]).endswith("\n"):
            self._put("\n")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        raw = self.get_starttag_text() or ""
        if not self._known(tag, raw):
            self._put(raw)
            return
        self.spans.append((self._at(), self._at() + len(raw), "tag", tag))
        if tag in SILENT and tag != "head":
            self.silent += 1
        elif tag == "br":
            self._put("\n")
        elif re.fullmatch("h[1-6]", tag):
            self._line()
            self._put("#" * int(tag[1]) + " ")
        elif tag in ("td", "th"):
            self._put("| " if not self.cells else " | ")
            self.cells += 1
        elif tag in BLOCKS:
            self._line()
            self._put({"li": "- "}.get(tag, ""))
            self.cells = 0 if tag == "tr" else self.cells
        elif tag in ("pre", "code"):
            self._put("`")
        elif tag == "img" and (alt := dict(attrs).get("alt")):
            self._put(alt)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT and tag != "head":
            self.silent -= 1

    def handle_endtag(self, tag: str) -> None:
        at = self._at()
        stop = self.text.find(">", at) + 1 or len(self.text)
        self.spans.append((at, stop, "tag", tag))
        if tag in SILENT and tag != "head":
            self.silent = max(0, self.silent - 1)
        elif tag == "tr" and self.cells:
            self._put(" |")
            self.cells = 0
            self._line()
        elif tag in BLOCKS or re.fullmatch("h[1-6]", tag):
            self._line()
        elif tag in ("pre", "code"):
            self._put("`")

    def handle_comment(self, data: str) -> None:
        at = self._at()
        if self.text.startswith("<!--", at):
            self.spans.append((at, min(len(self.text), at + len(data) + 7), "comment", ""))
        elif data and not self.text.startswith("<!", at) and not self.text.startswith("<?", at) and not self.text.startswith("</", at):
            self._put(data)
        else:
            self.spans.append((at, at + len(data) + 3, "comment", ""))

    def handle_decl(self, decl: str) -> None:
        self.spans.append((self._at(), self._at() + len(decl) + 3, "comment", ""))

    def handle_pi(self, data: str) -> None:
        self.spans.append((self._at(), self._at() + len(data) + 3, "comment", ""))

    def unknown_decl(self, data: str) -> None:
        self.spans.append((self._at(), self._at() + len(data) + 5, "comment", ""))

    def _reference(self, raw: str, whole: bool, plain: str) -> None:
        if whole:
            self.spans.append((self._at(), self._at() + len(raw), "reference", raw))
        self._put(plain if whole else raw)

    def handle_entityref(self, name: str) -> None:
        at = self._at()
        whole = self.text.startswith(";", at + 1 + len(name)) and name + ";" in html5
        raw = f"&{name};" if self.text.startswith(";", at + 1 + len(name)) else f"&{name}"
        self._reference(raw, whole, html5.get(name + ";", ""))

    def handle_charref(self, name: str) -> None:
        whole = self.text.startswith(";", self._at() + 2 + len(name))
        raw = f"&#{name};" if whole else f"&#{name}"
        self._reference(raw, whole, html.unescape(raw))

    def handle_data(self, data: str) -> None:
        self._put(data)


def _html(text: str) -> tuple[list[tuple[int, int, str, str]], str]:
    """Spans and clean text of the HTML in a text; a tag or reference that the text's end cuts off is a span too."""
    spans, tail = [], ""
    for cut, kind in ((_TAG_CUT, "tag"), (_ENTITY_CUT, "reference")):
        if m := cut.search(text):
            name = re.match(r"</?([A-Za-z0-9:-]*)", m.group())
            word = name.group(1).lower() if name and kind == "tag" else ""
            begun = len(word) > 1 and m.group()[1:].isascii() and m.group().lstrip("</").isalpha() and any(e.startswith(word) for e in ELEMENTS)
            if kind == "reference" or not word or word in ELEMENTS or begun or "=" in m.group():
                if kind == "tag" and not word and m.group() in ("<", "</"):
                    continue
                spans.append((m.start(), len(text), kind, ""))
                text = text[: m.start()]
                break
    if "<" in text or "&" in text:
        got = _Events(text)
        spans += got.spans
        text = "".join(got.out)
    return spans, text + tail


def _tag_tail(text: str) -> int:
    """Where the rest of a tag ends with which a cut text begins; 0 if it begins with none."""
    edge = _FIRST_EDGE.search(text)
    if not edge or edge.group() != ">":
        return 0
    head = text[: edge.start()].removesuffix("/").rstrip()
    return edge.end() if head.endswith(("\"", "-", "/")) else 0


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every sign of markup in a text, sorted."""
    if not _MAY_HOLD.search(text):
        return []
    found = []
    for m in _CODE.finditer(text):
        found.append((m.start(), m.end(), "code"))
    for m in _FORMULA.finditer(text):
        found.append((m.start(), m.end(), "formula"))
    found += [(a, b, kind) for a, b, kind, _ in _html(text)[0]]
    if tail := _tag_tail(text):
        found.append((0, tail, "tag"))
    for name, rule in RULES:
        for m in rule.finditer(text):
            if m.end() > m.start():
                found.append((m.start(), m.end(), name))
    numbers = [int(m.group(1)) for m in _LIST_LINES.finditer(text)]
    if numbers and (len(numbers) < 2 or numbers != [*range(numbers[0], numbers[0] + len(numbers))]):
        found = [s for s in found if not (s[2] == "list" and text[s[0] : s[1]].strip()[:1].isdigit())]  # the number of a text, verse or page
    whole = [(a, b) for a, b, kind in found if kind in ("code", "formula")]
    return sorted(s for s in found if s[2] in ("code", "formula") or not any(a <= s[0] and s[1] <= b for a, b in whole))


#: Kinds of spans that are structure of the content, not of the page about it.
STRUCTURE = frozenset(("code", "formula", "list", "heading", "table", "quote", "rule", "fence", "bold", "emphasis", "struck", "wiki mark"))


def _in_spans(text: str, found: list[tuple[int, int, str]], but: frozenset[str] = frozenset()) -> np.ndarray:
    """Mask of the characters within spans, those of the kinds ``but`` left out."""
    mask = np.zeros(len(text) + 1, np.int64)
    for a, b, kind in found:
        if kind not in but:
            mask[a] += 1
            mask[min(b, len(text))] -= 1
    return np.cumsum(mask[:-1]) > 0


def line_ratios(text: str, found: list[tuple[int, int, str]] | None = None, but: frozenset[str] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Of each line, characters of text by characters of tags (at least 1), and what the ratio were without tags: its length. Line ends belong to no line; kinds ``but`` are text."""
    tags = _in_spans(text, spans(text) if found is None else found, but)
    total = np.zeros(len(text) + 1, np.int64)
    np.cumsum(tags, out=total[1:])
    ends = np.fromiter((m.start() for m in re.finditer(r"\n|\Z", text)), np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size, tag = ends - starts, total[ends] - total[starts]
    return (size - tag) / np.maximum(1, tag), size.astype(float)


def marked_lines(ratios: np.ndarray, bare: np.ndarray, sigma: float = 1.0, gap: float = 0.0) -> np.ndarray:
    """Mask of the lines in regions of markup: how far (in logarithms) the ratios fall below those of bare lines, smoothed, above the middle of its two clusters.

    The lower cluster begins at bare text, the upper at the largest value, which is therefore always above the middle: no line is marked if and only if no line has tags.
    Clusters nearer than ``gap`` to one another tell nothing apart, and no line is marked.
    """
    fall = np.log1p(bare) - np.log1p(ratios)
    radius = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    # The border repeats, so that the first and last lines lose nothing.
    smooth = np.convolve(np.pad(fall, radius, mode="edge"), kernel / kernel.sum(), mode="valid")
    low, high = 0.0, float(smooth.max())
    if high <= 0:
        return np.zeros(len(fall), bool)
    for _ in range(50):
        near = smooth - low < high - smooth
        following = float(smooth[near].mean()) if near.any() else 0.0, float(smooth[~near].mean())
        if following == (low, high):
            break
        low, high = following
    return (smooth > (low + high) / 2) & (high - low >= gap)


def holds_markup(text: str, found: list[tuple[int, int, str]] | None = None) -> bool:
    """Whether a text has a region of markup."""
    found = spans(text) if found is None else found
    return bool(found) and bool(marked_lines(*line_ratios(text, found)).any())


def content_lines(text: str, found: list[tuple[int, int, str]] | None = None) -> np.ndarray:
    """Mask of the lines of content: all but those in regions that stand out by their tags and have more tags than text. Structure (headings, lists, tables, code, formulas) is content."""
    ratios, bare = line_ratios(text, found, STRUCTURE)
    said = np.flatnonzero(bare > 0)  # empty lines belong to what is around them
    out = np.ones(len(bare), bool)
    if len(said):
        out[said] = ~(marked_lines(ratios[said], bare[said], gap=1.0) & (ratios[said] < 1))
    return out


def clean(text: str) -> str:
    """The text without its markup; headings, lists, tables, code and formulas in one plain notation. Text without markup comes back unchanged."""
    if not spans(text):
        return text
    kept: list[str] = []
    text = text.replace("\ufdd0", "").replace("\ufdd1", "")

    def keep(value: str) -> str:
        kept.append(value)
        return f"\ufdd0{len(kept) - 1}\ufdd1"

    text = _CODE.sub(lambda m: keep(m.group().strip("\n") if m.group().lstrip().startswith(("```", "~~~")) else f"`{m.group().strip('`')}`"), text)
    text = _FORMULA.sub(lambda m: keep("$" + re.sub(r"^(?:\\[(\[]|\$+)\s*|\s*(?:\\[)\]]|\$+)$", "", m.group()) + "$"), text)
    while True:  # escaped markup may be markup again; each round shortens the text or is the last
        before = text
        text = _html(_AMPS.sub("&", text[_tag_tail(text) :]))[1]
        if len(text) >= len(before):
            break
    # Wiki
    text = re.sub(r"\{\{[^{}\n]*(?:\}\}|$)|\}\}", "", text)
    text = re.sub(r"(?m)^(?:\{\||\|\}|\|-)[^\n]*\n?", "", text)
    text = re.sub(r"(?m)^\|(?!\|)(?![^\n]*\|[ \t]*$)[ \t]*([^\n]*)$", lambda m: "| " + " | ".join(c.strip() for c in m.group(1).split("||")) + " |", text)
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]\n]*)(?:\]\]|$)", r"\1", text).replace("[[", "").replace("]]", "")
    text = re.sub(r"\[(?:https?|ftp)://[^\s\]]*[ \t]*([^\]\n]*)\]?", r"\1", text)
    text = re.sub(r"(?<![\w'])('{2,5})(?=[^\s'])([^'\n]*(?:'[^'\n]+)*?)'{2,5}(?!')", r"\2", text)
    text = re.sub(r"(?<![\w'])'{2,5}(?=[^\s'])([^'\n]*)$", r"\1", text)
    text = re.sub(r"(?m)^(={1,6})[ \t]*([^=\s][^\n]*?)[ \t]*={1,6}[ \t]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text)
    text = re.sub(r"(?m)^(={2,6}) ([^=\n]+)\Z", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text)
    # LaTeX
    text = re.sub(r"\\(?:sub)*section\*?\{([^{}\n]*)\}?", r"# \1", text)
    text = re.sub(r"\\item(?![A-Za-z])[ \t]*", "- ", text)
    text = re.sub(r"\\(?:begin|end)\{[A-Za-z]*\*?\}?\n?", "", text)
    text = re.sub(r"\\footnote\{([^{}\n]*)\}?", r" (\1)", text)
    text = re.sub(r"\\[A-Za-z]{2,}\*?(?:\[[^\]\n]*\])?(?:\{([^{}\n]*)\}?)?", lambda m: m.group(1) or "", text)
    # Markdown
    text = re.sub(r"(?m)^(\S[^\n]*)\n(={3,}|-{3,})[ \t]*$", lambda m: ("# " if m.group(2)[0] == "=" else "## ") + m.group(1), text)
    text = re.sub(r"!?\[([^\[\]\n]+)\]\([^()\s]*\)?", r"\1", text)
    text = re.sub(r"(?m)^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*\n?", "", text)
    text = re.sub(r"(?m)^ {0,3}>[ \t]?", "", text)
    text = re.sub(r"(?<![\w*])\*\*(?=[^\s*])([^*\n]*?)\*\*(?!\w)", r"\1", text)
    text = re.sub(r"(?<![\w*])\*\*(?=[^\s*])([^*\n]*)$", r"\1", text)
    text = re.sub(r"(?<![\w*])\*(?=[^\s*])([^*\n]*?[^\s*]|)\*(?![\w*])", r"\1", text)
    text = re.sub(r"(?<![\w_])(_{1,2})(?=[^\s_])([^_\n]*?[^\s_]|[^\s_])\1(?![\w_])", r"\2", text)
    text = re.sub(r"~~([^~\n]+)~~", r"\1", text)
    text = re.sub(r"\ufdd0(\d+)\ufdd1", lambda m: kept[int(m.group(1))], text)
    text = re.sub(r"(?m)[ \t]+$", "", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def read_markup(df: DataFrame, text: str, keep: list[str], want: bool = True) -> DataFrame:
    """The columns ``keep`` with ``found`` (whether the text holds markup), ``kinds``, ``clean`` and ``content`` (clean text of the content regions only), a row for each row of df.

    A text is found if it has a region of markup (``marked_lines``). Without ``want`` only ``found`` is worked out. Null: not found, null texts. Empty and very long texts are read whole. Cut-off markup counts. Columns not named are not read.
    """
    if not want:

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("_text").to_pylist()
                cols = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_text"]
                names = [f.name for f in batch.schema if f.name != "_text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([bool(t) and holds_markup(t) for t in texts], pa.bool_())], names=[*names, "found"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("_text").to_pylist():
                found = spans(t) if t else []
                if not found or not holds_markup(t, found):
                    rows.append((False, [], t, t))
                    continue
                whole = clean(t)
                good = content_lines(t, found)
                part = whole if good.all() else clean("\n".join(line for line, ok in zip(t.split("\n"), good, strict=True) if ok))
                rows.append((True, sorted({k for _, _, k in found}), whole, part))
            cols = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_text"]
            names = [f.name for f in batch.schema if f.name != "_text"]
            made = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = (pa.bool_(), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(list(v), k) for v, k in zip(made, kinds, strict=True)]], names=[*names, "found", "kinds", "clean", "content"])

    src = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = [f"c{i} {src.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = src.mapInArrow(work if want else find, ", ".join([*head, "found boolean"] + (["kinds array<string>", "clean string", "content string"] if want else [])))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *[c for c in out.columns if not re.fullmatch(r"c\d+", c)])
