"""Benchmark decontamination by q-gram filtering and banded alignment.

Finds the places where a document holds a benchmark item with at most
``rate`` edits per character.  Both sides are compared lower-cased, with each
run of characters other than letters and digits as one space.

Q-gram lemma: an item of m characters that is aligned with at most k edits
shares at least m - q + 1 - k * q of its q-grams with the text, and all of
them lie within k diagonals (text position minus item position) of the
alignment's start.  So

1. a document's q-grams are looked up among the items' (a bit table first,
   then the sorted hashes), and items with fewer hits than their bound leave,
2. hits are counted by item in diagonal bands of 2 * (2k + 1) diagonals that
   overlap by half, so any alignment's hits lie within one band; each of the
   item's grams counts once in a band, however often the text repeats it,
3. bands that reach the item's bound are verified by a bit-parallel alignment
   of the whole item against the text under that band.

An item too short for its edits at this q is looked for with shorter grams:
of length m // (k + 1), at which one gram at least stays whole.

Documents stream through Arrow functions and are never shuffled.  The items
are the stated query set: they are dealt into blocks of about BLOCK_CHARS
characters, and each block is broadcast and held against all documents in its
turn, so what a worker holds does not grow with the benchmark.

Defined cases: null texts and items hold nothing; an item of fewer than Q
characters is looked for exactly, between spaces; items of no letter or digit
are never found; repeated rows and items are reported each; an empty table
gives no rows; other columns pass through :func:`remove_contaminated`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare_python

Q = 8
RATE = 0.1
BLOCK_CHARS = 8 << 20
BITS = 22

_GAP = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    return _GAP.sub(" ", text.lower()).strip()


def _places(text: str) -> list[int]:
    """For each character of ``normal(text)`` its place in ``text``, and behind them the end of the last."""
    low = [k for k, c in enumerate(text) for _ in c.lower()]
    out, at, lowered = [], 0, text.lower()
    for m in _GAP.finditer(lowered):
        out += low[at:m.start()]
        if out and m.end() < len(lowered):
            out.append(low[m.start()])
        at = m.end()
    out += low[at:]
    return [*out, out[-1] + 1 if out else 0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash for each q-gram; runs of doubled length are added up, so the work is in proportion to log q."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    run, width = codes.astype(np.uint64), 1
    out, have = None, 0
    n = len(codes)
    for bit in range(q.bit_length()):
        if q >> bit & 1:  # append this run behind what is there
            if out is None:
                out, have = run, width
            else:
                size = n - have - width + 1
                out = out[:size] * np.uint64(pow(base, width, 1 << 64)) + run[have:have + size]
                have += width
        if 2 * width <= q:
            size = n - 2 * width + 1
            run = run[:size] * np.uint64(pow(base, width, 1 << 64)) + run[width:width + size]
            width *= 2
    out = out[:n - q + 1]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


class Grams:
    """The q-grams of those items of a block that are looked for at one ``q``."""

    def __init__(self, q: int, which: list[int], texts: list[str], edits: list[int]):
        self.q = q
        self.edits = np.zeros(max(which) + 1, np.int64)
        self.bounds = np.zeros(max(which) + 1, np.int64)
        for k in which:
            self.edits[k], self.bounds[k] = edits[k], len(texts[k]) - q + 1 - edits[k] * q
        grams = [gram_hashes(_codes(texts[k]), q) for k in which]
        flat = np.concatenate(grams)
        item = np.repeat(np.array(which), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(flat, kind="stable")
        self.item, self.at = item[order].astype(np.int32), at[order].astype(np.int32)
        self.hashes, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << BITS, bool)
        self.table[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def bands(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, first diagonal) of the bands that hold as many of the item's grams as an alignment leaves whole."""
        hashes = gram_hashes(codes, self.q)
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        if not len(maybe):
            return
        found = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[found] == hashes[maybe]
        places, found = maybe[hit], found[hit]
        if not len(places):
            return
        n = self.count[found]
        entry = np.repeat(self.first[found] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        item = self.item[entry].astype(np.int64)
        enough = np.bincount(item, minlength=len(self.bounds)) >= self.bounds
        kept = enough[item]
        if not kept.any():
            return
        entry, item, at = entry[kept], item[kept], self.at[entry[kept]].astype(np.int64)
        band = (np.repeat(places, n)[kept] - at) // (2 * self.edits[item] + 1)
        # distinct (item, band, place in the item), each hit in its two bands
        item, band, at = np.concatenate((item, item)), np.concatenate((band, band - 1)), np.concatenate((at, at))
        order = np.lexsort((at, band, item))
        item, band, at = item[order], band[order], at[order]
        new_band = np.append(True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]))
        new_gram = new_band | np.append(True, at[1:] != at[:-1])
        starts = np.flatnonzero(new_band)
        grams = np.add.reduceat(new_gram.astype(np.int64), starts)
        for k in starts[grams >= self.bounds[item[starts]]]:
            yield int(item[k]), int(band[k]) * (2 * int(self.edits[item[k]]) + 1)


@dataclass
class Items:
    """A block of benchmark items with their q-grams."""

    ids: list
    texts: list[str]
    q: int
    rate: float
    edits: list[int] = field(init=False)

    def __post_init__(self):
        self.edits = [int(len(t) * self.rate) for t in self.texts]
        by_q = defaultdict(list)
        for k, t in enumerate(self.texts):
            if len(t) >= self.q:
                by_q[max(1, min(self.q, len(t) // (self.edits[k] + 1)))].append(k)
        self.grams = [Grams(q, which, self.texts, self.edits) for q, which in by_q.items()]
        # so short that one edit in ``1 / rate`` characters is none, or that there is nothing to count grams of
        self.short = [k for k, t in enumerate(self.texts) if 0 < len(t) < self.q]

    def regions(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the items found in a normalised text; the best place of overlapping ones."""
        for k in self.short:
            at = f" {text} ".find(f" {self.texts[k]} ")
            while at >= 0:
                yield k, 0, at, at + len(self.texts[k])
                at = f" {text} ".find(f" {self.texts[k]} ", at + 1)
        codes = _codes(text)
        for grams in self.grams:
            for k, diagonal in grams.bands(codes):
                yield from self._verified(text, k, diagonal)

    def _verified(self, text: str, k: int, diagonal: int) -> Iterator[tuple[int, int, int, int]]:
        item, edits = self.texts[k], self.edits[k]
        # all diagonals of the band and as many more on either side as edits can lead to
        start, end = max(0, diagonal - edits), max(0, diagonal + 2 * (2 * edits + 1) + edits) + len(item) + 1
        exact = text.find(item, start, end)
        if exact >= 0:
            yield k, 0, exact, exact + len(item)
        elif edits and (found := aligned(item, text[start:end], edits)):
            yield k, found[0], start + found[1], start + found[2]


def _ends(item: str, text: str, free: bool) -> Iterator[int]:
    """Least edits of the whole ``item`` against texts that end behind each character of ``text``, column by column in one integer's bits.

    ``free``: the text counted may begin anywhere; otherwise it begins with ``text``.
    """
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    every, top = (1 << len(item)) - 1, 1 << len(item) - 1
    plus, minus, score = every, 0, len(item)
    for c in text:
        eq = masks[c] if c in masks else 0
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & every, plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = (up << 1 | (not free)) & every
        down = down << 1 & every
        plus, minus = down | ~(diagonal | up) & every, up & diagonal
        yield score


def aligned(item: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the shortest of the best places of ``item`` in ``text``; None if it takes more than ``most`` edits."""
    best, end = most + 1, 0
    for k, score in enumerate(_ends(item, text, True), 1):
        if score < best:
            best, end = score, k
    if best > most:
        return None
    back = text[max(0, end - len(item) - most):end][::-1]
    size = next(k for k, score in enumerate(_ends(item[::-1], back, False), 1) if score == best)
    return best, end - size, end


def best_places(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of the places where the same item overlaps itself, the one with the fewest edits (then the first)."""
    by_item = defaultdict(list)
    for x in found:
        by_item[x[0]].append(x)
    out = []
    for places in by_item.values():
        kept: list[tuple[int, int, int, int]] = []
        for x in sorted(places, key=lambda x: (x[1], x[2], x[3])):
            if all(x[3] <= y[2] or y[3] <= x[2] for y in kept):
                kept.append(x)
        out += kept
    return sorted(out)


def _blocks(items: DataFrame, item_col: str, text_col: str, q: int, rate: float) -> Iterator[Items]:
    """The benchmark, block by block; each block is read on its own."""
    rows = items.select(F.col(item_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows
        block = part.orderBy("id", "text").collect()
        yield Items([r.id for r in block], [normal(r.text) for r in block], q, rate)


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """(id_col, item_col, edits, item_chars, start, end): each place in ``docs`` that holds an item, in code points of the document's text."""
    spark = docs.sparkSession
    prepare_python(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    id_type, item_type = dict(rows.dtypes)["id"], dict(items.dtypes)[item_col]
    schema = f"`{id_col}` {id_type}, `{item_col}` {item_type}, edits int, item_chars int, start bigint, `end` bigint"
    out = None
    for block in _blocks(items, item_col, item_text, q, rate):
        shared = spark.sparkContext.broadcast(block)
        part = rows.mapInArrow(lambda it, shared=shared: _scan(it, shared.value), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _scan(it: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    for batch in it:
        where, rows = [], []
        for n, text in enumerate(batch.column(1)):
            raw = text.as_py()
            found = best_places(list(items.regions(normal(raw))))
            if found:
                places = _places(raw)
                for k, edits, start, end in found:
                    where.append(n)
                    rows.append((items.ids[k], edits, len(items.texts[k]), places[start], places[end - 1] + 1))
        if rows:
            ids, edits, chars, starts, ends = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where)), pa.array(ids), pa.array(edits, pa.int32()), pa.array(chars, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["id", "item", "edits", "item_chars", "start", "end"])


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", item_col: str = "item_id",
                        q: int = Q, rate: float = RATE) -> DataFrame:
    """``docs`` without the rows whose text holds an item; rows with null text stay.  One pass over the texts per block."""
    prepare_python(docs.sparkSession)
    at = docs.columns.index(text_col)
    for block in _blocks(items, item_col, item_text, q, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(it, shared=shared):
            for batch in it:
                ok = [t.as_py() is None or next(shared.value.regions(normal(t.as_py())), None) is None for t in batch.column(at)]
                if any(ok):
                    yield batch.filter(pa.array(ok))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
