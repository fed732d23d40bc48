"""Encoding by a public byte-level BPE vocabulary, the merges made by recursive DuckDB queries inside each task.

A batch of texts is cut into words by the vocabulary's pattern; its distinct words become token-position rows, one per byte. A recursive query joins neighbouring positions with
the merge table and contracts, in every word at once, the pair of the lowest rank from the left on, until no word has a pair left; an ordered aggregation gives each word's ids.
Words are mapped back to their texts by array gathers. No text or word is shuffled; only the vocabulary's merge table (its size is fixed) is sent to the tasks.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khayt.llm import codepoints as cp

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: How the vocabulary cuts text to words (fixed value of the public vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of distinct words in one recursive query, and words that a worker remembers between batches; both only bound memory.
BYTES_AT_ONCE, WORDS_KEPT = 256_000, 400_000
#: A recursive query holds every step it makes. So that a long word (a run of letters without a blank) takes no more memory than many short ones, a query makes so many steps that
#: about this many rows are held, and words that are not done by then begin the next one as they stand.
ROWS_HELD, MOST_STEPS = 4_000_000, 64

#: {steps}: how many. {every}: whether all places of the chosen pair are contracted in one step, or the leftmost only.
_STEP = """
with recursive state(step, word, pos, tok) as (
  select 0, word, pos, tok from start
  union all
  (with held as (
     select step, word, pos, tok, lead(tok) over w as following, row_number() over w as n from state where step < {steps} window w as (partition by word order by pos)),
   choice as (
     select h.word, min((m.rank::bigint << 32) | h.pos) as pick from held h join merges m on h.tok = m.a and h.following = m.b group by h.word),
   hit as (
     select h.*, m.made, coalesce(h.tok = m.a and h.following = m.b, false) and ({every} or h.pos = (c.pick & 4294967295)) as here
     from held h join choice c on h.word = c.word join merges m on m.rank = (c.pick >> 32)),
   -- Places of the pair that overlap (the same token twice) are taken from the left, every second one.
   taken as (
     select *, here and (n - coalesce(max(case when not here then n end) over (partition by word order by pos), 0)) % 2 = 1 as take from hit),
   done as (
     select step + 1 as step, word, pos, case when take then made else tok end as tok, lag(take) over (partition by word order by pos) as gone from taken)
   select step, word, pos, tok from done where gone is distinct from true)
),
last as (select word, max(step) as step from state group by word)
select s.word, any_value(s.step) as step, list(s.tok order by s.pos) as ids from state s join last l on s.word = l.word and s.step = l.step group by s.word order by s.word
"""


@cache
def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file: printable bytes for themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_vocabulary(path: str = TOKENIZER) -> dict[str, np.ndarray]:
    """Merge table (a, b, made: token ids in order of rank) and the token id of each byte. Reads the JSON form, or ranks of bytes (.tiktoken)."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        pairs = sorted((made, ids[t[:i]], ids[t[i:]]) for t, made in ids.items() for i in range(1, len(t)) if t[:i] in ids and t[i:] in ids)
        single = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        # Every cut of a token into two tokens merges at that token's rank; to keep ranks distinct, cuts of one token are numbered in order.
        return {"a": np.array([a for _, a, _ in pairs], np.int32), "b": np.array([b for _, _, b in pairs], np.int32), "made": np.array([m for m, _, _ in pairs], np.int32), "single": single}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    letters = byte_letters()
    return {
        "a": np.array([ids[a] for a, _ in merges], np.int32), "b": np.array([ids[b] for _, b in merges], np.int32), "made": np.array([ids[a + b] for a, b in merges], np.int32),
        "single": np.array([ids[letters[b]] for b in range(256)], np.int32),
    }


class Encoder:
    """Encodes batches of texts; one per worker process, so that the merge table is loaded and common words are encoded once."""

    def __init__(self, vocabulary: dict[str, np.ndarray], pattern: str = PATTERN) -> None:
        import duckdb
        import regex

        self.cut = regex.compile(pattern).findall
        self.single = vocabulary["single"]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "preserve_insertion_order": False})
        rank = np.arange(len(vocabulary["a"]), dtype=np.int32)
        merges = pa.table({"rank": rank, **{k: vocabulary[k] for k in ("a", "b", "made")}})
        self.con.register("merges_in", merges)
        self.con.execute("create table merges as select * from merges_in")
        self.con.unregister("merges_in")
        # Where a token's own merge always ranks before the merges that use it, contracting one place of a pair brings no lower rank to another place of it.
        own = np.full(int(max(vocabulary["made"].max(), vocabulary["single"].max())) + 1, -1)
        np.maximum.at(own, vocabulary["made"], rank)
        self.every = bool((own[vocabulary["a"]] < rank).all() and (own[vocabulary["b"]] < rank).all())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = [0]

    def _contract(self, tok: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many of each word) of words given as the ids of their bytes end to end."""
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(size)
        of = np.arange(len(size))
        while len(of):
            steps = int(min(MOST_STEPS, max(1, ROWS_HELD // max(1, len(tok)))))
            pos = np.arange(len(tok)) - np.repeat(np.cumsum(size) - size, size)
            self.con.register("start", pa.table({"word": np.repeat(np.arange(len(of), dtype=np.int32), size), "pos": pos.astype(np.int32), "tok": tok}))
            got = self.con.sql(_STEP.format(steps=steps, every=str(self.every).lower())).to_arrow_table()
            self.con.unregister("start")
            made = got["ids"].combine_chunks()
            made = made.chunk(0) if isinstance(made, pa.ChunkedArray) else made
            flat, ends = made.flatten().to_numpy().astype(np.int32), made.offsets.to_numpy() - made.offsets[0].as_py()
            going = got["step"].to_numpy() >= steps
            for w in np.flatnonzero(~going):
                ids[of[w]] = flat[ends[w] : ends[w + 1]]
            tok = np.concatenate([flat[ends[w] : ends[w + 1]] for w in np.flatnonzero(going)]) if going.any() else flat[:0]
            of, size = of[going], np.diff(ends)[going]
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    def _store(self, part: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        end = self.ends[-1]
        while end + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[end : end + len(flat)] = flat
        base = len(self.ends) - 1
        self.known.update(zip(part, range(base, base + len(part)), strict=True))
        self.ends.extend((end + np.cumsum(lens)).tolist())

    def _learn(self, new: list[str]) -> None:
        every = [w.encode("utf-8", "replace") for w in new]
        edge = np.cumsum([0, *map(len, every)]) // BYTES_AT_ONCE
        for k in range(int(edge[-1]) + 1):
            lo, hi = np.searchsorted(edge[:-1], [k, k + 1])
            if lo == hi:
                continue
            raw = every[lo:hi]
            self._store(new[lo:hi], *self._contract(self.single[np.frombuffer(b"".join(raw), np.uint8)], np.fromiter(map(len, raw), np.int64, len(raw))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, row starts) of an array of texts; null and empty texts have none."""
        cut = [self.cut(t) if t else [] for t in texts.to_pylist()]
        per = np.fromiter(map(len, cut), np.int64, len(cut))
        words = pa.array([w for row in cut for w in row], pa.string()).dictionary_encode()
        del cut
        names = words.dictionary.to_pylist()
        if len(self.known) + len(names) > WORDS_KEPT:
            self.forget()
        if new := [w for w in names if w not in self.known]:
            self._learn(new)
        ends = np.array(self.ends, np.int64)
        at = np.fromiter((self.known[w] for w in names), np.int64, len(names))
        code = at[words.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
        start, size = ends[code], ends[code + 1] - ends[code]
        stop = np.zeros(len(code) + 1, np.int64)
        np.cumsum(size, out=stop[1:])
        ids = self.flat[np.arange(stop[-1]) - np.repeat(stop[:-1] - start, size)]
        row = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=row[1:])
        return ids, stop[row]


_own: dict[str, Encoder] = {}


def _encoder(name: str, vocabulary: dict[str, np.ndarray]) -> Encoder:
    if name not in _own:
        _own[name] = Encoder(vocabulary)
    return _own[name]


def _shared(spark: SparkSession, path: str):
    """The merge table for the tasks; its size is the vocabulary's, about a megabyte."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode(df: DataFrame, key: str, text: str, path: str = TOKENIZER, count_only: bool = False) -> DataFrame:
    """(key, ids) or, if only counts are wanted, (key, tokens): one row for each row of df, without special tokens.

    A null and an empty text both have an empty list (0 tokens). Strings that look like special tokens are ordinary text. Long texts are encoded whole. Repeated keys keep their rows.
    Columns that are not named are not read. An unpaired surrogate counts as ``?``.
    """
    shared = _shared(df.sparkSession, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared.value)
        for batch in batches:
            keys, texts = batch.column(0), cp.column(batch.column(1))
            for a, b in cp.pieces(texts):
                ids, starts = encoder.encode(texts.slice(a, b - a))
                made = pa.array(np.diff(starts), pa.int64()) if count_only else pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), made], names=["k", "made"])

    src = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = src.schema["k"].dataType.simpleString()
    out = src.mapInArrow(work, f"k {kind}, made {'bigint' if count_only else 'array<int>'}")
    return out.select(F.col("k").alias(key), F.col("made").alias("tokens" if count_only else "ids"))


def token_bytes(path: str = TOKENIZER) -> list[bytes]:
    """The bytes of each token id of a JSON vocabulary, special tokens as their text."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    back = {c: b for b, c in byte_letters().items()}
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def decode(df: DataFrame, key: str, ids: str, path: str = TOKENIZER) -> DataFrame:
    """(key, text): the text of each row's ids, by ordered aggregation of the tokens' bytes in DuckDB. Null ids are an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(token_bytes(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB"})
        con.register("v", pa.table({"id": pa.array(range(len(shared.value)), pa.int32()), "hex": [b.hex() for b in shared.value]}))
        con.execute("create table vocabulary as select * from v")
        for batch in batches:
            con.register("given", pa.table({"row": np.arange(batch.num_rows), "ids": batch.column(1)}))
            got = con.execute("""select g.row, coalesce(string_agg(v.hex, '' order by g.pos), '') as hex
              from (select row, unnest(ids) as id, generate_subscripts(ids, 1) as pos from given) g join vocabulary v on v.id = g.id group by g.row""").fetchall()
            text = [""] * batch.num_rows
            for row, hexed in got:
                text[row] = bytes.fromhex(hexed).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text)], names=["k", "text"])

    src = df.select(F.col(key).alias("k"), F.col(ids).alias("i"))
    return src.mapInArrow(work, f"k {src.schema['k'].dataType.simpleString()}, text string").select(F.col("k").alias(key), "text")


