"""Tenant cuts of the driver's TPC-H-like tables, for the query catalogue.

Tenants are cut on natural attributes (no key arithmetic): customers by
market segment, orders by status, parts by size, suppliers by nation,
line items by line status or by their order's tenant, events by day of
month.  Overlapping cuts give colliding keys; the sub's copy of an
overlapping row carries a changed amount (``+ 1.0``) so "incoming wins" is
visible in the result.  Every row of the source table lands in at least one
tenant, so the work of every query grows with the tables.

Each cut exists twice: as a DataFrame builder and as the equivalent DuckDB
CTE text used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Tenant

#: fixed values: tenant cut attributes
SEG_MAIN = ("AUTOMOBILE", "BUILDING", "FURNITURE")
SEG_SUB = ("FURNITURE", "HOUSEHOLD", "MACHINERY")
SEG_THIRD = ("MACHINERY", "AUTOMOBILE")
STATUS_MAIN = ("F", "O")
STATUS_SUB = ("O", "P")
STATUS_THIRD = ("P", "F")


_READS: dict[str, tuple[SparkSession, DataFrame]] = {}


def read(spark: SparkSession, d: str, t: str) -> DataFrame:
    """One read per (live session, path): listing and schema inference happen once, plans reuse it.

    The cached object is a lazy plan, not data; the driver tables are
    read-only, so reusing their file listing is safe.  A plan is reused only
    by the same, still running session.
    """
    path = f"{d}/{t}.parquet"
    hit = _READS.get(path)
    if hit is not None and hit[0] is spark and not spark.sparkContext._jsc.sc().isStopped():
        return hit[1]
    df = spark.read.parquet(path)
    _READS[path] = (spark, df)
    return df


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ------------------------------------------------------------------ customer
def customer_cut(spark, d, segs, bump: float = 0.0) -> DataFrame:
    c = read(spark, d, "customer").where(F.col("c_mktsegment").isin(*segs))
    return c.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(bump)) if bump else c


def customer_cut_sql(name: str, segs, bump: float = 0.0) -> str:
    bal = f"c_acctbal + {bump}" if bump else "c_acctbal"
    return (f"{name} AS (SELECT c_custkey, c_name, c_nationkey, {bal} AS c_acctbal, c_mktsegment "
            f"FROM customer WHERE c_mktsegment IN {_in(segs)})")


def cm(spark, d):
    return customer_cut(spark, d, SEG_MAIN)


def cs(spark, d):
    return customer_cut(spark, d, SEG_SUB, 1.0)


def ct(spark, d):
    return customer_cut(spark, d, SEG_THIRD, 2.0)


CM = customer_cut_sql("cm", SEG_MAIN)
CS = customer_cut_sql("cs", SEG_SUB, 1.0)
CT = customer_cut_sql("ct", SEG_THIRD, 2.0)


# -------------------------------------------------------------------- orders
def orders_cut(spark, d, statuses, bump: float = 0.0) -> DataFrame:
    o = read(spark, d, "orders").where(F.col("o_orderstatus").isin(*statuses))
    return o.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(bump)) if bump else o


def orders_cut_sql(name: str, statuses, bump: float = 0.0) -> str:
    price = f"o_totalprice + {bump}" if bump else "o_totalprice"
    return (f"{name} AS (SELECT o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, o_orderdate, "
            f"o_orderpriority FROM orders WHERE o_orderstatus IN {_in(statuses)})")


def om(spark, d):
    return orders_cut(spark, d, STATUS_MAIN)


def os_(spark, d):
    return orders_cut(spark, d, STATUS_SUB, 1.0)


def ot(spark, d):
    return orders_cut(spark, d, STATUS_THIRD, 2.0)


OM = orders_cut_sql("om", STATUS_MAIN)
OS = orders_cut_sql("os", STATUS_SUB, 1.0)
OT = orders_cut_sql("ot", STATUS_THIRD, 2.0)


# ------------------------------------------------------------------ lineitem
def lines_of(spark, d, orders: DataFrame) -> DataFrame:
    """Line items of a tenant's orders (semi join on the order key)."""
    return read(spark, d, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey")),
                                            "l_orderkey", "left_semi")


LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")


def lines_of_sql(name: str, orders_cte: str) -> str:
    return (f"{name} AS (SELECT {LINE_COLS} FROM lineitem WHERE EXISTS "
            f"(SELECT 1 FROM {orders_cte} o WHERE o.o_orderkey = lineitem.l_orderkey))")


def lm_status(spark, d):
    return read(spark, d, "lineitem").where(F.col("l_linestatus") == "O")


def ls_status(spark, d):
    return read(spark, d, "lineitem").where(F.col("l_linestatus") == "F")


LM_STATUS = f"lm AS (SELECT {LINE_COLS} FROM lineitem WHERE l_linestatus = 'O')"
LS_STATUS = f"ls AS (SELECT {LINE_COLS} FROM lineitem WHERE l_linestatus = 'F')"


# ------------------------------------------------------------ part, supplier
def part_cut(spark, d, lo=None, hi=None) -> DataFrame:
    p = read(spark, d, "part")
    if lo is not None:
        p = p.where(F.col("p_size") > lo)
    if hi is not None:
        p = p.where(F.col("p_size") <= hi)
    return p


def part_cut_sql(name, lo=None, hi=None) -> str:
    conds = []
    if lo is not None:
        conds.append(f"p_size > {lo}")
    if hi is not None:
        conds.append(f"p_size <= {hi}")
    return f"{name} AS (SELECT * FROM part WHERE {' AND '.join(conds) or 'TRUE'})"


def supplier_cut(spark, d, lo=None, hi=None) -> DataFrame:
    s = read(spark, d, "supplier")
    if lo is not None:
        s = s.where(F.col("s_nationkey") >= lo)
    if hi is not None:
        s = s.where(F.col("s_nationkey") < hi)
    return s


def supplier_cut_sql(name, lo=None, hi=None) -> str:
    conds = []
    if lo is not None:
        conds.append(f"s_nationkey >= {lo}")
    if hi is not None:
        conds.append(f"s_nationkey < {hi}")
    return f"{name} AS (SELECT * FROM supplier WHERE {' AND '.join(conds) or 'TRUE'})"


# -------------------------------------------------------------------- events
def event_zone() -> F.Column:
    """Events shard by day of month: days 1-10 zone 1, 11-20 zone 2, later zone 3."""
    day = F.dayofmonth("ts")
    return F.when(day <= 10, F.lit(1)).when(day <= 20, F.lit(2)).otherwise(F.lit(3)).cast("int")


EVENT_ZONE_SQL = "CAST(CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END AS INTEGER)"


def events_zoned(spark, d) -> DataFrame:
    return read(spark, d, "events").withColumn("zone", event_zone())


EVENTS_ZONED = f"ez AS (SELECT event_id, ts, user_id, event_type, value, props, {EVENT_ZONE_SQL} AS zone FROM events)"


# ------------------------------------------------------------------- tenants
SPECS = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey",
         "nation": "n_nationkey", "region": "r_regionkey"}


def main_tenant(spark, d, tables=("customer", "orders")) -> Tenant:
    src = {"customer": lambda: cm(spark, d), "orders": lambda: om(spark, d),
           "lineitem": lambda: lines_of(spark, d, om(spark, d))}
    return Tenant("main", 1, {t: src[t]() for t in tables}, SPECS)


def sub_tenant(spark, d, tables=("customer", "orders")) -> Tenant:
    src = {"customer": lambda: cs(spark, d), "orders": lambda: os_(spark, d),
           "lineitem": lambda: lines_of(spark, d, os_(spark, d))}
    return Tenant("sub", 2, {t: src[t]() for t in tables}, SPECS)
