"""N-gram Jaccard join with Bayesian candidate pruning.

Finds all pairs of texts whose sets of five-word shingles have a Jaccard
similarity of ``threshold`` or more.

1. Every text becomes a set of shingle hashes, and that a MinHash signature:
   BANDS bands of ROWS values for finding candidates and CHECKS further values
   for judging them.  A pair of similarity 0.8 shares no band with a
   probability of 5e-8.  Texts of the same words are one *text* from here on,
   under the 128-bit digest of its words.
2. Texts that share a band meet in a bucket.  Buckets with the same members
   are visited once.  A bucket is cut into blocks of BLOCK members, and each
   pair of blocks is a task group of its own.  There the CHECKS values are
   compared step by step; a pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold (uniform prior) falls
   below TOLERANCE.  What survives is sent on as a spanning forest, never as
   pairs, and its connected components are *families*.
3. Within families, again by pairs of blocks, all pairs of texts are pruned in
   the same way and the survivors verified exactly on their shingle sets.  The
   verified links leave as counts per text and as a spanning forest, whose
   connected components are the classes.

No cap is set anywhere, no group is collected into one task and no pair is a
row.  Copies cost one count.  Signatures, buckets and families are written
tables in the shared folder.

Result, one row per document: ``class_id`` (the least document id that it is
linked with, directly or through others), ``text_id`` (hex digest of its
words), ``n_copies`` (documents with the same words, itself included),
``n_linked_texts`` (different texts linked with its own) and ``n_links``
(documents linked with it: copies and those of linked texts).

Words are what stands between white space, lower-cased.  Defined cases: a
text of fewer than five words has one shingle, all its words; a text without
words (null, empty) has none, is linked with nothing and is its own class;
repeated rows are copies; null ids are possible and never the class id where
another id is there; an empty table gives an empty table; other columns are
left out of the links and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, attach, connected, fresh, prepare_python, scratch_table

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
CHECKS, STEP = 64, 8
TOLERANCE = 1e-8
BLOCK = 384
#: shingles of a block in a family, about
BLOCK_SHINGLES = 1 << 20
SEED = 20240229


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = BANDS * ROWS + CHECKS
    return rng.integers(0, 2**64, n, np.uint64) | np.uint64(1), rng.integers(0, 2**64, n, np.uint64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each step the matches below which a pair is dropped.

    With a uniform prior and m of n values equal the similarity is
    Beta(m + 1, n - m + 1), and P(it reaches t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, CHECKS + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out.append(m)
    return out


def word_hashes(text: Column) -> Column:
    """The hashes of a text's lower-cased words, in order."""
    inner = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))
    return F.transform(words, lambda w: F.xxhash64(w))


def text_digest(text: Column) -> Column:
    """128-bit digest of a text's lower-cased words; null if there are none."""
    inner = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(inner != "", F.unhex(F.md5(F.regexp_replace(inner, r"[\x20\x09-\x0D]+", " ").cast("binary"))))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted set of shingle hashes of one text's word hashes."""
    w = words.view(np.uint64)
    if len(w) < WORDS:
        h = np.full(1 if len(w) else 0, len(w) + 1, np.uint64)
        for x in w:
            h = _mix(h * np.uint64(0x100000001B3) + x)
        return h
    h = np.zeros(len(w) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        h = _mix(h * np.uint64(0x100000001B3) + w[k:len(w) - WORDS + 1 + k])
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (int64, texts x BANDS) and check values (uint32, texts x CHECKS) of non-empty sets."""
    mul, add = _functions()
    mins = np.empty((len(mul), len(sets)), np.uint64)
    at, k = 0, 0
    while k < len(sets):  # about a cache's worth of shingles at a time
        n, total = k, 0
        while n < len(sets) and (n == k or total + len(sets[n]) <= 32768):
            total += len(sets[n])
            n += 1
        flat = np.concatenate(sets[k:n])
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[k:n - 1]]))).astype(np.int64)
        for f in range(len(mul)):
            mins[f, k:n] = np.minimum.reduceat(flat * mul[f] + add[f], starts)
        k = n
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b + 1, np.uint64)
        for r in range(ROWS):
            key = _mix(key * np.uint64(0x100000001B3) + mins[b * ROWS + r])
        keys[:, b] = key
    return keys.view(np.int64), (mins[BANDS * ROWS:] >> np.uint64(32)).astype(np.uint32).T


def _signed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        lists = batch.column(2)
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        sets = [shingles(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
        if not sets:
            continue
        keys, checks = signatures(sets)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1))),
             pa.array([c.tobytes() for c in checks], pa.binary())], ["id", "text", "n", "keys", "checks"])


def prune(checks: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs (i, j) survive the step-by-step comparison of their check values, as positions."""
    left, matches = np.arange(len(i)), np.zeros(len(i), np.int16)
    for step, need in enumerate(least):
        cols = slice(step * STEP, (step + 1) * STEP)
        matches += (checks[i, cols] == checks[j, cols]).sum(1, dtype=np.int16)
        ok = matches >= need
        i, j, left, matches = i[ok], j[ok], left[ok], matches[ok]
        if not len(i):
            break
    return left


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n members the least member that the links (i, j) connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def groups(it: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of one key at a time, from batches sorted by ``key``; groups are bounded by their blocks."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in it:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in key]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is not None and tuple(c[0] for c in cols) != last
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        last = tuple(c[-1] for c in cols)
        at = 0
        for cut in np.flatnonzero(change):
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield _joined(held)
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def pairs_between(block: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Position pairs of a group: within its block, or between its two blocks; some at a time."""
    if low == high:
        for k in range(1, len(block)):
            i = np.arange(len(block) - k)
            yield i, i + k
    else:
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for x in a:
            yield np.full(len(b), x), b


def chunks_of_pairs(block: np.ndarray, low: int, high: int, size: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, n = [], 0
    for i, j in pairs_between(block, low, high):
        held.append((i, j))
        n += len(i)
        if n >= size:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _checks(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("checks")).to_pylist()), np.uint32).reshape(-1, CHECKS)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _edges(ids: pa.Array, label: np.ndarray) -> pa.RecordBatch | None:
    own = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(own)), ids.take(pa.array(label[own]))], ["a", "b"]) if len(own) else None


def _survivors(least: list[int]):
    def run(it):
        for g in groups(it, ["key", "low", "high"]):
            if g.num_rows < 2:
                continue
            checks, block = _checks(g), _numbers(g, "block")
            links = []
            for i, j in chunks_of_pairs(block, int(_numbers(g, "low")[0]), int(_numbers(g, "high")[0])):
                ok = prune(checks, i, j, least)
                links.append((i[ok], j[ok]))
            i, j = map(np.concatenate, zip(*links)) if links else (np.zeros(0, int),) * 2
            if len(i) and (out := _edges(g.column(g.schema.get_field_index("text")), forest(g.num_rows, i, j))) is not None:
                yield out
    return run


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) have a Jaccard similarity of ``threshold`` or more, exactly."""
    ok = np.zeros(len(i), bool)
    sizes = np.array([len(s) for s in sets])
    num = int(round(threshold * 1000))
    order = np.argsort(i, kind="stable")
    cuts = np.flatnonzero(np.diff(i[order])) + 1
    for part in np.split(order, cuts):
        own = sets[i[part[0]]]
        # a pair whose sizes differ too much can't reach the threshold
        part = part[np.minimum(sizes[j[part]], len(own)) * 1000 >= num * np.maximum(sizes[j[part]], len(own))]
        for k in range(0, len(part), 256):
            some = part[k:k + 256]
            others = [sets[x] for x in j[some]]
            flat = np.concatenate(others) if others else own[:0]
            if not len(flat):
                continue
            at = np.searchsorted(own, flat)
            hit = own[np.minimum(at, len(own) - 1)] == flat
            starts = np.concatenate(([0], np.cumsum([len(s) for s in others])[:-1]))
            both = np.add.reduceat(hit.astype(np.int64), starts)
            ok[some] = both * 1000 >= num * (len(own) + sizes[j[some]] - both)
    return ok


def _links(least: list[int], threshold: float):
    def run(it):
        for g in groups(it, ["family", "low", "high"]):
            names = g.column(g.schema.get_field_index("text")).to_pylist()
            if any(a == b for a, b in zip(names, names[1:])):
                g = g.take(pa.array([k for k, x in enumerate(names) if not k or names[k - 1] != x]))
            ids = g.column(g.schema.get_field_index("text"))
            block, copies = _numbers(g, "block"), _numbers(g, "copies")
            checks, low, high = _checks(g), int(_numbers(g, "low")[0]), int(_numbers(g, "high")[0])
            lists = g.column(g.schema.get_field_index("words"))
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            sets = [shingles(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
            texts, docs = np.zeros(g.num_rows, np.int64), np.zeros(g.num_rows, np.int64)
            links = [(np.zeros(0, int),) * 2]
            for i, j in chunks_of_pairs(block, low, high):
                ok = prune(checks, i, j, least)
                i, j = i[ok], j[ok]
                ok = verified(sets, i, j, threshold)
                i, j = i[ok], j[ok]
                for x, y in ((i, j), (j, i)):
                    texts += np.bincount(x, minlength=len(texts))
                    docs += np.bincount(x, copies[y], minlength=len(texts)).astype(np.int64)
                links.append((i, j))
            label = forest(g.num_rows, *map(np.concatenate, zip(*links)))
            yield pa.RecordBatch.from_arrays([ids, ids.take(pa.array(label)), pa.array(texts), pa.array(docs)], ["a", "b", "n_linked_texts", "n_linked_docs"])
    return run


def _tiles(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Each member once for each pair of blocks that its own block is part of, sorted by pair."""
    own = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int"))
    tiles = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    return tiles.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high", "text")


def _families(texts: DataFrame, least: list[int]) -> DataFrame:
    """(text, family) for the texts that some other text may be similar to."""
    members = texts.select("text", F.explode("keys").alias("key"))
    buckets = scratch_table(members.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("text")).alias("x1"),
                                                       F.bit_xor(F.xxhash64(F.lit(1), "text")).alias("x2")).where("size > 1"), "buckets")
    once = buckets.groupBy("size", "x1", "x2").agg(F.min("key").alias("key")).select("key", "size")
    meet = members.join(once, "key").join(texts.select("text", "checks"), "text")
    tiles = _tiles(meet, "key", F.ceil(F.col("size") / BLOCK)).select("key", "low", "high", "block", "text", "checks")
    edges = tiles.mapInArrow(_survivors(least), "a binary, b binary")
    return connected(scratch_table(edges, "survivors")).select(F.col("node").alias("text"), F.col("label").alias("family"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: ``id``, ``class_id``, ``text`` (digest), ``class_text`` (least digest of its class), ``n_copies``, ``n_linked_texts``, ``n_links``."""
    if not THRESHOLD <= threshold <= 1:
        raise ValueError(f"the bands are laid out for thresholds from {THRESHOLD} to 1")
    prepare_python(docs.sparkSession)
    least = least_matches(threshold, tolerance)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    worded = rows.select("id", text_digest(F.col("t")).alias("text"), word_hashes(F.col("t")).alias("words")).where("text IS NOT NULL")
    signed = scratch_table(worded.mapInArrow(_signed, f"id {dict(rows.dtypes)['id']}, text binary, n bigint, keys array<bigint>, checks binary"), "signed")
    counts = signed.groupBy("text").agg(F.count("*").alias("copies"), F.min("id").alias("first"), F.max("n").alias("n"))
    counts = scratch_table(counts, "texts")
    texts = scratch_table(signed.select("text", "keys", "checks").dropDuplicates(["text"]), "signatures")
    family = scratch_table(_families(texts, least), "families")
    sizes = family.join(counts, "text").groupBy("family").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("blocks")
    members = family.join(sizes.select("family", blocks), "family").join(counts, "text").join(texts.select("text", "checks"), "text")
    members = scratch_table(members.select("text", "family", "blocks", "copies", "first", "checks"), "members")
    # the document with the least id brings a text's words; repeated rows of it meet in the same tiles
    own = rows.join(members, rows["id"].eqNullSafe(members["first"])).where(text_digest(F.col("t")) == F.col("text"))
    own = own.drop("id", "first").withColumn("words", word_hashes(F.col("t"))).drop("t")
    tiles = _tiles(own, "family", F.col("blocks")).select("family", "low", "high", "block", "text", "copies", "checks", "words")
    linked = scratch_table(tiles.mapInArrow(_links(least, threshold), "a binary, b binary, n_linked_texts bigint, n_linked_docs bigint"), "links")
    sums = linked.groupBy(F.col("a").alias("text")).agg(F.sum("n_linked_texts").alias("n_linked_texts"), F.sum("n_linked_docs").alias("n_linked_docs"))
    labels = connected(linked.where("a <> b").select("a", "b"))
    per_text = (counts.join(sums, "text", "left").join(labels.withColumnsRenamed({"node": "text"}), "text", "left")
                .select("text", "copies", "first", F.coalesce("label", "text").alias("label"),
                        F.coalesce("n_linked_texts", F.lit(0)).alias("n_linked_texts"),
                        (F.col("copies") - 1 + F.coalesce("n_linked_docs", F.lit(0))).alias("n_links")))
    per_text = scratch_table(per_text, "linked-texts")
    least_id = per_text.groupBy("label").agg(F.min("first").alias("class_id"))
    per_text = per_text.join(least_id, "label").select("text", "copies", F.col("copies").alias("n_copies"), F.col("label").alias("class_text"), "class_id", "n_linked_texts", "n_links")
    found = attach(signed.select("id", "text"), scratch_table(per_text, "classes"), "text", "copies", F.xxhash64("id", "text"))
    none = rows.where(text_digest(F.col("t")).isNull()).select(
        "id", F.lit(None).cast("binary").alias("text"), F.lit(None).cast("binary").alias("class_text"), F.lit(1).cast("long").alias("n_copies"), F.col("id").alias("class_id"),
        F.lit(0).cast("long").alias("n_linked_texts"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(none)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the least (id, words); all its columns, and one row where rows are repeated.

    Documents without words are kept.
    """
    docs = fresh(docs, ["__nj_text", "__nj_key"], [id_col, text_col])
    found = classes(docs, id_col, text_col, threshold).where("text IS NOT NULL")
    best = found.groupBy("class_text").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text")).alias("k"))
    best = best.select(F.col("k.text").alias("__nj_text"), F.xxhash64("k.id", "k.text").alias("__nj_key"))
    keyed = docs.withColumn("__nj_text", text_digest(F.col(text_col))).withColumn("__nj_key", F.xxhash64(id_col, "__nj_text"))
    # the id is part of the key, so copies of one text don't gather
    kept = keyed.join(best, ["__nj_text", "__nj_key"]).dropDuplicates(["__nj_text", "__nj_key"]).select(*docs.columns)
    return kept.unionByName(docs.where(text_digest(F.col(text_col)).isNull()))
