"""From raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``, ``n_chars`` kept true to the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardfold.llm import bpe, decontaminate, line_dedup, ngram_jaccard
from shardfold.llm import quality_rules as qr
from shardfold.llm.common import read, scratch_table
from shardfold.llm.queries import tokenizer_file

TOKENIZER = "word_bpe_49k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: only documents that pass the base rules and whose host isn't rejected."""
    # the row travels as one struct, so its columns can have any names; a document that
    # fails is counted for its host, but its row is needed no more
    rows = docs.select(F.struct(*docs.columns).alias("row"), "source", "text")
    measured = qr.measure(rows).withColumn("row", F.when(~F.col("base_failed"), F.col("row"))).drop("text")
    return qr.judge(scratch_table(measured, "measured")).where("kept").select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: all documents, without the lines that ten or more of them share."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each class of near copies."""
    return ngram_jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: only documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: the token ids of each document, and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, tokenizer_file(TOKENIZER), keep_ids=True)


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard", keep_one_of_each),
    ("decontaminate", drop_contaminated),
    ("bpe", encode_and_decode),
]

#: SQL can express neither the classes of near copies nor the alignment; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
