"""A left join with a unique-key table that one frequent key can't slow down.

Foreign keys are skewed: 0 and other "unset" ids, a default guild, a common
name.  Joined by key, all rows of such a value meet in one task.
:func:`lookup` counts the left side's keys (map-side partial counts), takes
the ``HEAVY`` most frequent ones with their matches as a broadcast table of
bounded size, and deals the rows that it decides by their content; no other
key holds more than 1/HEAVY of the rows.  A right side that Spark broadcasts
by itself needs none of this and is joined as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: at most so many keys are broadcast; other keys hold less than one in HEAVY of the rows
HEAVY = 1024
#: keys with fewer rows than this can't make a task uneven
LEAST_ROWS = 1000


def broadcasts_itself(df: DataFrame) -> bool:
    """True if Spark's own estimate of ``df`` is within the session's broadcast threshold."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    limit = conf.autoBroadcastJoinThreshold()
    return limit > 0 and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def spread(df: DataFrame) -> Column:
    """A number that deals rows evenly: the hash of a row and of the partition it is read in, so repeated rows part too."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)], F.spark_partition_id())


def lookup(left: DataFrame, on: Column | str, right: DataFrame, key: str, values: Mapping[str, str],
           least_rows: int = LEAST_ROWS) -> DataFrame:
    """``left`` with ``values`` (new name -> column of ``right``) where ``on`` equals ``right.key``, null elsewhere.

    ``right`` holds each key once.  NULL keys match nothing.  A value column
    that is null in ``right`` can't be told from no match: ask for the key
    itself (``{"__hit": key}``) where that matters.
    """
    on = F.col(on) if isinstance(on, str) else on
    table = right.select(F.col(key).alias("__lk_r"), *[F.col(c).alias(f"__lk_v{i}") for i, c in enumerate(values.values())])
    base = left.withColumn("__lk_on", on)
    names = [F.col(f"__lk_v{i}").alias(n) for i, n in enumerate(values)]
    if broadcasts_itself(table):
        return base.join(table, F.col("__lk_on") == F.col("__lk_r"), "left").select(*left.columns, *names)
    counted = base.where(F.col("__lk_on").isNotNull()).groupBy(F.col("__lk_on").alias("__lk_h")).agg(F.count(F.lit(1)).alias("__lk_n"))
    heavy = counted.where(F.col("__lk_n") >= least_rows).orderBy(F.desc("__lk_n"), "__lk_h").limit(HEAVY)
    inner = [F.col(f"__lk_v{i}").alias(f"__lk_w{i}") for i in range(len(values))]
    # heavy keys without a match are in the list too: their rows are decided as well
    heavy = heavy.join(table, F.col("__lk_h") == F.col("__lk_r"), "left").select("__lk_h", *inner)
    out = base.withColumn("__lk_s", spread(left)).join(F.broadcast(heavy), F.col("__lk_on") == F.col("__lk_h"), "left")
    open_ = F.col("__lk_h").isNull() & F.col("__lk_on").isNotNull()
    dealt = out.withColumn("__lk_d", F.when(open_, F.xxhash64("__lk_on")).otherwise(F.col("__lk_s"))) \
        .withColumn("__lk_on", F.when(open_, F.col("__lk_on")))
    rest = table.withColumn("__lk_j", F.xxhash64("__lk_r"))
    joined = dealt.join(rest, (F.col("__lk_d") == F.col("__lk_j")) & (F.col("__lk_on") == F.col("__lk_r")), "left")
    return joined.select(*left.columns, *[F.coalesce(f"__lk_w{i}", f"__lk_v{i}").alias(n) for i, n in enumerate(values)])
