"""Line deduplication: drop lines that many documents share.

Lines are exploded by key, hashed, counted by document, and the lines whose
key reaches ``min_docs`` documents are dropped; what stays is put together
again by position.  A line's key is the line with white space stripped at
both ends and A-Z lower-cased.

Native: DataFrame and SQL functions only.

* Counting sends one row per key and task (map-side partial counts), so a
  line that stands in every document costs no more than any other.
* The ``HEAVY`` most frequent keys (a fixed number of rows) are broadcast;
  the other frequent keys, none of which holds more than 1/HEAVY of the
  lines, are joined by key.  Rows decided by the broadcast are dealt by their
  own position in that join, so no key gathers in one task.
* Only the positions to drop travel per document; the text moves once.

Defined cases: null text counts as one empty line and stays null if the text
column is returned; empty keys are never dropped (``min_chars`` >= 1); rows
of one id count as one document, rows without an id as one each, and repeated
rows all get the same result; an empty table gives an empty table; other columns pass through, but for
those named like a requested count, which takes their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, HEAVY, ascii_lower, attach, fresh, hash128, let, scratch_table

MIN_DOCS = 10
MIN_CHARS = 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column, min_chars: int) -> Column:
    """One struct per line: position and 128-bit key, without the lines whose key is too short.

    The text is lower-cased as a whole, as no letter makes or takes a line
    feed, and a line's key is computed once for its length and both hashes.
    """
    def entry(line, pos):
        return let(F.btrim(line, F.lit(BLANKS)), lambda key: F.when(F.length(key) >= min_chars, _place(key, pos)))
    return F.filter(F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1), entry), lambda x: x.isNotNull())


def _place(key: Column, pos: Column) -> Column:
    h1, h2 = hash128(key)
    return F.struct(pos.alias("pos"), h1.alias("h1"), h2.alias("h2"))


def _different(keys: Column) -> Column:
    """The different (h1, h2) of ``keys``; sorted, since Spark compares all pairs of an array's structs to find the distinct ones."""
    hashes = F.sort_array(F.transform(keys, lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    return let(hashes, lambda hs: F.filter(hs, lambda x, i: (i == 0) | (x != F.get(hs, i - 1))))


def frequent_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                   id_col: str = "doc_id") -> DataFrame:
    """(h1, h2, n): keys that stand in at least ``min_docs`` documents, rows of one id being one document.

    Rows whose id no other row has, which are most, are counted as they are.
    Of the others each (key, id) is counted once; ids are few bytes, and one
    that a third of all rows share is taken together in each task first.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = docs.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("again", F.lit(True))
    ids = scratch_table(ids, "repeated-ids")
    own = _different(_keys(F.col("text"), min_chars))
    if ids.isEmpty():
        keys = docs.select(F.explode(own).alias("k"))
    else:
        spread = F.xxhash64("id", "text")
        marked = attach(docs.withColumn("deal", spread), ids, "id", "rows", F.col("deal")).withColumn("k", F.explode(own))
        keys = marked.where("again IS NULL").select("k").unionByName(marked.where("again").select("id", "k").distinct().select("k"))
    return keys.groupBy(F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")).agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS, n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """``docs`` with the frequent lines cut from ``text_col``; on request with the counts of lines and dropped lines."""
    if min_chars < 1:
        raise ValueError("min_chars must be 1 at least: empty lines are never dropped")
    added = ["__ld_k1", "__ld_k2", "__ld_drop", *filter(None, (n_lines, n_dropped))]
    docs = fresh(docs, added, [id_col, text_col])
    frequent = scratch_table(frequent_lines(docs, text_col, min_docs, min_chars, id_col), "frequent-lines")
    heavy = frequent.orderBy(F.desc("n"), "h1", "h2").limit(HEAVY).select("h1", "h2", F.lit(True).alias("hot"))
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    lines = (docs.select(k1.alias("k1"), k2.alias("k2"), F.explode(_keys(F.col(text_col), min_chars)).alias("x"))
             .select("k1", "k2", "x.pos", "x.h1", "x.h2")
             .join(F.broadcast(heavy), ["h1", "h2"], "left")
             .withColumn("j1", F.when(F.col("hot"), F.xxhash64("k1", "pos")).otherwise(F.col("h1"))))
    rest = frequent.select(F.col("h1").alias("j1"), F.col("h2").alias("r2"), F.lit(True).alias("warm"))
    hits = (lines.join(rest, (lines["j1"] == rest["j1"]) & (lines["h2"] == rest["r2"]), "left")
            .where(F.col("hot") | F.col("warm")))
    drops = hits.groupBy("k1", "k2").agg(F.collect_set("pos").alias("__ld_drop")).withColumnsRenamed({"k1": "__ld_k1", "k2": "__ld_k2"})
    keyed = docs.withColumns({"__ld_k1": k1, "__ld_k2": k2}).join(drops, ["__ld_k1", "__ld_k2"], "left")
    lines_ = _lines(F.col(text_col))
    text = F.when(F.col("__ld_drop").isNull(), F.col(text_col)).otherwise(_without(lines_, F.col("__ld_drop")))
    out = {}
    if n_lines:
        out[n_lines] = F.size(lines_).cast("long")
    if n_dropped:
        out[n_dropped] = F.coalesce(F.size("__ld_drop"), F.lit(0)).cast("long")
    return keyed.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns],
                        *[c.alias(n) for n, c in out.items()])


def _without(lines: Column, drop: Column) -> Column:
    """The lines at the positions that are not in ``drop``, joined; linear in the number of lines."""
    return let(lines, lambda ls: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), drop), lambda i: F.get(ls, i)), "\n"))
