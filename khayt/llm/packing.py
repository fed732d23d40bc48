"""Filling containers of fixed capacity with texts: vector bin packing by the dot-product heuristic.

An item has several sizes at once (tokens, one segment, loss-bearing tokens) and a container a limit for each. A container is filled by taking, again and again, the item
that fits and whose sizes have the largest dot product with the room left. Items are packed in chunks of bounded size, drawn evenly by a hash of their key; items of equal sizes
are one class with a count, so that a choice costs a product over the classes. Containers left with much room are opened again and their items packed once more,
together with those of other chunks, until no round closes enough of them or what is open fits one chunk that has been packed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khayt.llm import bpe
from khayt.runtime import stored

CAPACITY = 4096
#: Segments and loss-bearing tokens that a container may hold.
MAX_SEGMENTS, MAX_LOSS = 48, 4032
#: Items that one task packs at once.
CHUNK_ITEMS = 50_000
#: A container with more of its tokens unused than this share is opened again in the next round.
OPEN_SHARE = 1 / 256
ROUNDS = 4


def pack(sizes: np.ndarray, limits: Sequence[int]) -> np.ndarray:
    """The container of each item. sizes: items x dimensions, each within the limits. Items of equal sizes are taken in their order."""
    n = len(sizes)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    limits = np.asarray(limits, np.int64)
    kinds, of = np.unique(sizes, axis=0, return_inverse=True)
    of = of.ravel()
    # Largest first, by the sum of the shares of the limits.
    weight = 1.0 / limits
    rank = np.argsort(-(kinds * weight).sum(axis=1), kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    kinds, of = kinds[rank], place[of]
    queue = np.argsort(of, kind="stable")
    left = np.bincount(of, minlength=len(kinds))
    head = np.cumsum(left) - left
    live = np.arange(len(kinds))
    columns = [np.ascontiguousarray(kinds[:, d]) for d in range(kinds.shape[1])]
    shares = [c * w for c, w in zip(columns, weight, strict=True)]
    # Items that take a larger share of the segments than of the tokens would fill containers of their own with little in them, were they left to the end; each container gets its part of them.
    slight = np.flatnonzero((kinds[:, 1] * weight[1] > kinds[:, 0] * weight[0]) & (kinds > 0).any(axis=1)) if kinds.shape[1] > 1 else live[:0]
    slight_left, rest = int(left[slight].sum()), kinds.T @ left.astype(np.int64)
    box = done = 0
    while done < n:
        if (left[live] == 0).sum() > len(live) // 4:  # classes that are used up leave the products
            live = live[left[live] > 0]
            columns, shares = [np.ascontiguousarray(kinds[live, d]) for d in range(kinds.shape[1])], [np.ascontiguousarray(kinds[live, d] * weight[d]) for d in range(kinds.shape[1])]
        room, taken = limits.copy(), 0
        there = left[live] > 0
        boxes = max(1.0, float((rest * weight).max()))
        due = math.ceil(slight_left / boxes) if boxes > 1 else 0
        while True:
            fits = there.copy()
            score = np.zeros(len(live))
            for c, s, r, w in zip(columns, shares, room.tolist(), weight.tolist(), strict=True):
                fits &= c <= r
                score += s * (r * w)
            k = int(np.where(fits, score, -1.0).argmax())
            if not fits[k]:
                break
            kind = live[k]
            if taken and due > 0:  # after the first item, which is as large as can be
                while len(slight) and not left[slight[0]]:
                    slight = slight[1:]
                if len(slight) and (kinds[slight[0]] <= room).all():
                    kind = slight[0]
                    k = int(np.searchsorted(live, kind))
                due -= 1
            out[queue[head[kind]]] = box
            head[kind] += 1
            left[kind] -= 1
            there[k] = left[kind] > 0
            room -= kinds[kind]
            rest -= kinds[kind]
            slight_left -= int(kinds[kind, 1] * weight[1] > kinds[kind, 0] * weight[0]) if len(weight) > 1 else 0
            taken += 1
        if not taken:
            raise ValueError("an item exceeds a limit")
        done += taken
        box += 1
    return out


def _pack_sorted(tokens: np.ndarray, loss: np.ndarray, limits: Sequence[int]) -> np.ndarray:
    return pack(np.stack([tokens, np.ones_like(tokens), loss], axis=1), limits)


def split_items(sized: DataFrame, key: str, tokens: str, loss: str | None, capacity: int) -> DataFrame:
    """(key, piece, start, tokens, loss): texts longer than a container as full pieces and a rest, all others whole."""
    n = F.col(tokens).cast("bigint")
    pieces = F.greatest(F.lit(1), F.ceil(n / capacity)).cast("int")
    cut = sized.select(F.col(key).alias(key), n.alias("_n"), (F.col(loss).cast("bigint") if loss else n).alias("_loss"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    size = F.least(F.lit(capacity), F.col("_n") - F.col("piece") * capacity)
    # Loss-bearing tokens are shared among the pieces in proportion, rounded up, and never exceed the piece.
    part = F.when(F.col("_n") > 0, F.least(size, F.ceil(F.col("_loss") * size / F.col("_n")))).otherwise(F.lit(0)).cast("bigint")
    return cut.select(key, "piece", (F.col("piece").cast("bigint") * capacity).alias("start"), size.cast("bigint").alias("tokens"), part.alias("loss"))


def pack_items(items: DataFrame, key: str, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, chunk: int = CHUNK_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """The items (key, piece, start, tokens, loss) with ``container``, an id as text, and ``used``, the tokens in that container.

    Every item is in exactly one container; no container exceeds a limit, but that an item with more loss-bearing tokens than the limit, which cannot be split as it fits a container,
    counts as the limit: it shares its container with items without loss only. An empty table gives no rows; items of no tokens take a segment and no room. The result
    is the same for the same items, whatever their order; an executor that is lost changes nothing.
    """
    limits = (capacity, max_segments, min(max_loss, capacity))
    kind = items.schema[key].dataType.simpleString()
    closed: list[DataFrame] = []
    now, count = items, items.count()
    for n in range(max(1, rounds)):
        parts = max(1, math.ceil(count / chunk))
        mixed = now.select(key, "piece", "start", "tokens", "loss").withColumn("_part", F.pmod(F.xxhash64(F.lit(n), F.col(key).cast("string"), "piece"), F.lit(parts)).cast("int"))

        def work(batches: Iterator[pa.RecordBatch], n: int = n) -> Iterator[pa.RecordBatch]:
            rows = [b for b in batches if b.num_rows]
            if not rows:
                return
            t = pa.Table.from_batches(rows).sort_by([("_part", "ascending"), ("tokens", "descending"), ("k", "ascending"), ("piece", "ascending")])
            part = t["_part"].to_numpy()
            tokens, loss = t["tokens"].to_numpy(), np.minimum(t["loss"].to_numpy(), limits[2])
            box, used = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for p in np.unique(part):
                lo, hi = np.searchsorted(part, [p, p + 1])
                got = _pack_sorted(tokens[lo:hi], loss[lo:hi], limits)
                box[lo:hi] = got
                used[lo:hi] = np.bincount(got, weights=tokens[lo:hi]).astype(np.int64)[got]
            names = pa.array([f"{n}-{p}-{b}" for p, b in zip(part.tolist(), box.tolist(), strict=True)])
            t = t.drop(["_part"]).append_column("container", names).append_column("used", pa.array(used))
            yield from t.combine_chunks().to_batches()

        cols = mixed.withColumnRenamed(key, "k").select("k", "piece", "start", "tokens", "loss", "_part")
        packed = stored(cols.repartition(parts, "_part").mapInArrow(work, f"k {kind}, piece int, start bigint, tokens bigint, loss bigint, container string, used bigint").withColumnRenamed("k", key), "packed")
        full = F.col("used") >= F.lit(capacity) * F.lit(1 - OPEN_SHARE)
        open_items = packed.where(~full)
        still = open_items.count()
        if n == rounds - 1 or still == 0 or parts == 1 or still > 0.9 * count:
            closed.append(packed)
            break
        closed.append(packed.where(full))
        now, count = open_items, still
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def pack_texts(df: DataFrame, key: str, text: str, given: Column | None = None, path: str = bpe.TOKENIZER, capacity: int = CAPACITY, **limits: int) -> DataFrame:
    """(key, piece, start, tokens, loss, container, used): texts sized in tokens of a public vocabulary and packed; start is the piece's first token in its text.

    given: which texts are only given (prompts) and bear no loss; of all others all tokens do (null counts as not given). Only texts longer than a container are split. Null and empty
    texts are items of no tokens. Keys are unique.
    """
    bears = F.lit(True) if given is None else ~F.coalesce(given, F.lit(False))
    src = df.select(F.struct(F.col(key).alias("k"), bears.alias("b")).alias("key"), F.col(text).alias("text"))
    sized = bpe.encode(src, "key", "text", path, count_only=True)
    sized = stored(sized.select(F.col("key.k").alias(key), "tokens", F.when(F.col("key.b"), F.col("tokens")).otherwise(0).alias("loss")), "sized")
    return pack_items(split_items(sized, key, "tokens", "loss", capacity), key, capacity, **limits)


def packing_facts(packed: DataFrame, key: str, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS) -> DataFrame:
    """(fact, value): how many texts are placed whole or in the fewest pieces, and how many pieces or containers break a rule (none should)."""
    texts = packed.groupBy(key).agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("kinds"), F.max("piece").alias("last"))
    texts = texts.agg(
        F.count_if((F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("n") / capacity))) & (F.col("kinds") == F.col("pieces")) & (F.col("last") == F.col("pieces") - 1)).alias("texts placed"),
        F.count_if((F.col("pieces") > 1) & (F.col("n") <= capacity)).alias("split though they fit"),
    )
    boxes = packed.groupBy("container").agg(
        F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("segments"), F.sum(F.least("loss", F.lit(max_loss))).alias("loss"), F.min("used").alias("low"), F.max("used").alias("high")
    )
    boxes = boxes.agg(
        F.count_if(F.col("n") > capacity).alias("beyond capacity"), F.count_if(F.col("segments") > max_segments).alias("beyond segments"), F.count_if(F.col("loss") > max_loss).alias("beyond loss"),
        F.count_if((F.col("low") != F.col("n")) | (F.col("high") != F.col("n"))).alias("use misstated"),
    )
    both = [d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("fact"), F.col(c).cast("bigint").alias("value")) for c in d.columns]))) for d in (texts, boxes)]
    return both[0].unionByName(both[1])
