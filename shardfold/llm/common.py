"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Callable, Iterable, Sequence
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space that line and word rules strip and split at: space, tab, LF, VT, FF, CR.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys outside the HEAVY most frequent ones hold less than 1 / HEAVY of all rows each.
HEAVY = 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name in the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Later jobs start from files that every executor sees, so a lost executor
    costs no recomputation, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare_python(spark: SparkSession, max_bytes: int = 8 << 20) -> None:
    """Limit Arrow batches by bytes, unless the session's limit is lower, and ship this package to the executors."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key)).lower().rstrip("b")
    if not now.isdigit() or int(now) > max_bytes:
        spark.conf.set(key, str(max_bytes))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = Path(__file__).resolve().parents[1]
        folder = f"{SparkFiles.getRootDirectory()}/package"  # Spark's own folder on the driver, whose files it hands out
        os.makedirs(folder, exist_ok=True)
        with zipfile.ZipFile(f"{folder}/{top.name}.zip", "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(f"{folder}/{top.name}.zip")
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds; together a 128-bit key."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5EED), *cols)


def fresh(df: DataFrame, names: Iterable[str], needed: Iterable[str] = ()) -> DataFrame:
    """``df`` without the columns whose names an operator gives to its own; those take their place.

    Raises if one of them is a column that the operator reads.
    """
    names = {n.lower() for n in names}
    if clash := [c for c in needed if c.lower() in names]:
        raise ValueError(f"the operator reads {clash} and can't write columns of that name")
    return df.drop(*[c for c in df.columns if c.lower() in names])


def sized_slices(sizes: Sequence[int], max_bytes: int) -> Iterable[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``max_bytes`` (a larger single item stands alone)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def attach(left: DataFrame, right: DataFrame, key: str, weight: str, spread: Column) -> DataFrame:
    """``left`` with the other columns of ``right`` (one row per ``key``), null where no row matches.

    ``weight`` is the number of ``left``'s rows with that key.  The HEAVY
    heaviest rows of ``right`` are broadcast; no other key holds more than
    1/HEAVY of the rows, and those are joined by key.  Rows that need no
    second match are dealt by ``spread``, so no key gathers in one task.
    """
    values = [c for c in right.columns if c not in (key, weight)]
    light = right.select(F.col(key).alias("__at_r"), F.xxhash64(key).alias("__at_j"), F.struct(*values).alias("__at_v"))
    heavy = right.orderBy(F.desc(weight), key).limit(HEAVY).select(F.col(key).alias("__at_k"), F.struct(*values).alias("__at_h"))
    out = left.join(F.broadcast(heavy), F.col(key) == F.col("__at_k"), "left")
    out = out.withColumn("__at_s", F.when(F.col("__at_h").isNull() & F.col(key).isNotNull(), F.xxhash64(key)).otherwise(spread))
    out = out.join(light, (F.col("__at_s") == F.col("__at_j")) & (F.col(key) == F.col("__at_r")), "left")
    return out.select(*left.columns, *[F.coalesce(F.col("__at_h")[v], F.col("__at_v")[v]).alias(v) for v in values])


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node that each node of ``edges`` is connected with.

    Each round points every node to its least neighbour, follows those
    pointers twice, and contracts the edges along them; what is left shrinks
    by a factor each round, down to the paths' ends.  At last the pointers of
    all rounds are put together.  Every round is a written table; nothing is
    collected but whether edges are left.
    """
    def pairs(x: Column, y: Column, df: DataFrame) -> DataFrame:
        return scratch_table(df.where(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "edges")

    left = pairs(F.col(a), F.col(b), edges)
    rounds = []
    while not rounds or not left.isEmpty():
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        to = scratch_table(ends.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "pointers")
        for _ in range(2):
            onward = to.select(F.col("node").alias("via"), F.col("label").alias("next"))
            to = to.join(onward, to["label"] == onward["via"]).select("node", F.col("next").alias("label"))
        to = scratch_table(to, "pointers")
        rounds.append(to)
        at_a, at_b = (to.select(F.col("node").alias(c), F.col("label").alias(f"to_{c}")) for c in ("a", "b"))
        left = pairs(F.col("to_a"), F.col("to_b"), left.join(at_a, "a").join(at_b, "b"))
    out = rounds[-1]
    for to in reversed(rounds[:-1]):
        later = out.select(F.col("node").alias("via"), F.col("label").alias("end"))
        out = to.join(later, to["label"] == later["via"], "left").select("node", F.coalesce("end", "label").alias("label"))
    return out
