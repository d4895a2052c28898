"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Asymmetric q-chunks.  Of two words one edit apart, the shorter (or, of equal
length, the smaller) contributes chunks and the other grams.  A word's halves
are two disjoint chunks; one edit leaves one of them as it is, and in the
other word it stands at the same place or shifted by the one inserted code
point.  The half that the edit hit is halved again in the same way, so the
join key is everything but a quarter of the word.  Half a word alone is too
weak a key: thousands of words share a beginning.

* A word sends one row for each of its ``GAPS`` quarters as the chunk side and
  two as the gram side: once for partners of its own length (no shift) and once
  for partners one shorter (what follows the gap is shifted by one).  Grams at
  other places can't be joined within that shift and aren't sent.
* Rows are joined on a hash of length, gap, place and text; what joins is
  verified by a banded edit distance on the whole words, so hashes only cost time.
* A pair that several gaps find is kept at the first of them, which both words
  show by themselves; no pass for duplicates is needed.
* Words are counted before they are compared, so a frequent word is one row.

Occurrences are counted over all documents with partial counts in each task.
A form has at least ``RATIO`` times its variant's count, so chains of forms
are as short as the logarithm of the largest count.

Defined cases: null text has no words; a null id is written as the empty
string where it is hashed; repeated rows are documents like any other and
each count; ties between forms go to the smallest word in code-point order;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, scratch_table

LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
GAPS = 4


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
          damage: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): lower-cased letter runs of all texts and their occurrences.

    Where ``damage`` divides the crc32 of ``<id>:<run>``, the run loses the
    code point at that crc32 modulo its length (0 turns this off).
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text_col, F.lit(rf"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))).alias("run"))
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    runs = runs.select("id", low.alias("word"))
    if damage:
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        runs = (runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
                .select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least_chars))
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _edge(size: Column, k: int) -> Column:
    """Where the ``k``-th gap of a word of ``size`` code points begins: halves, halved again."""
    return F.floor(size * k / GAPS).cast("int")


def _rows(counted: DataFrame, shift: int) -> DataFrame:
    """(key, gap, size, word, n): one row per gap; ``shift`` is what the word has more than its partner."""
    size = F.length("word") - shift
    def entry(k: int) -> Column:
        tail = F.col("word").substr(_edge(size, k + 1) + shift + 1, F.length("word"))
        return F.struct(F.lit(k).alias("gap"), F.xxhash64(size, F.lit(k), F.col("word").substr(F.lit(1), _edge(size, k)), tail).alias("key"))
    return counted.select("word", "n", F.explode(F.array(*[entry(k) for k in range(GAPS)])).alias("x")).select("x.key", "x.gap", "word", "n")


def near_pairs(counted: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of ``counted`` words that are one edit apart, once."""
    chunks = _rows(counted, 0)
    grams = _rows(counted, 0).withColumn("shift", F.lit(0)).unionByName(_rows(counted, 1).withColumn("shift", F.lit(1)))
    grams = grams.select("key", F.col("gap").alias("other_gap"), F.col("word").alias("other"), F.col("n").alias("other_n"), "shift")
    found = chunks.join(grams, "key").where(F.col("gap") == F.col("other_gap"))
    one_side = (F.col("shift") == 1) | (F.col("word") < F.col("other"))
    start = F.floor(F.length("word") * F.col("gap") / GAPS).cast("int")
    end = F.length("word")
    first = (F.col("gap") == 0) | (F.col("word").substr(start + 1, end) != F.col("other").substr(start + F.col("shift") + 1, end))
    same_size = F.length("other") == F.length("word") + F.col("shift")
    return (found.where(one_side & same_size & first).where(F.levenshtein("word", "other", 1) == 1)
            .select("word", "n", "other", "other_n"))


def group_variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``counted`` with form, root, n_near and form_n.

    A word's form is its near word of the largest n (ties: the smallest), if
    that is ``ratio`` times the word's own n or more; its root is where its
    chain of forms ends.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, so that chains of forms end")
    counted = scratch_table(counted.select("word", "n"), "words")
    pairs = near_pairs(counted)
    both = pairs.select(F.explode(F.array(F.struct("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
                                          F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    good = -F.col("b.m") >= ratio * F.col("n")
    out = scratch_table(counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("b.near")).alias("form"),
        F.when(good, -F.col("b.m")).alias("form_n")), "variants")
    ends = _roots(out.where(F.col("form").isNotNull()).select("word", "form"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word with a form; each round follows one form and keeps only words that still move."""
    done, moving = [], links.select("word", F.col("form").alias("at"))
    onward = links.select(F.col("word").alias("at"), "form")
    while True:
        step = scratch_table(moving.join(onward, "at", "left").select("word", "at", "form"), "chains")
        done.append(step.where(F.col("form").isNull()).select("word", F.col("at").alias("root")))
        moving = step.where(F.col("form").isNotNull()).select("word", F.col("form").alias("at"))
        if moving.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
