"""Query catalogue: one Spark plan per operator of the inventory, each paired
with an independent DuckDB SQL statement computing the same result.

Every query reads whole driver tables (cut into tenants, see ``tenants``).
Column names and types are aligned on both sides; money is summed as
DECIMAL so the result does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import make_guid, zone_of_guid
from ..model import Tenant
from ..operators import identity as I
from ..operators import keys as K
from ..operators import merge as M
from ..operators import names as N
from ..operators import retention as R
from ..operators import rows as P
from ..sources.sinks import merge_report
from . import jobs as J
from . import tenants as T
from .reconcile import ACCOUNT_FOLDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _max_sql(col: str, *ctes: str) -> str:
    parts = [f"(SELECT COALESCE(MAX({col}), 0) FROM {c})" for c in ctes]
    return parts[0] if len(parts) == 1 else f"GREATEST({', '.join(parts)})"


def _shift_sql(col: str, off: str) -> str:
    return f"CASE WHEN {col} > 0 THEN {col} + {off} ELSE {col} END"


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
OCOLS = ", ".join(ORDER_COLS)
CCOLS = ", ".join(CUST_COLS)


def _dec(c) -> F.Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


# =================================================================== merges
@query("replace_merge", _with(T.OM, T.OS) + """
SELECT * FROM om WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = om.o_orderkey)
UNION ALL SELECT * FROM os""")
def replace_merge(spark, d):
    """M1: incoming orders win on the order key."""
    return M.merge_replace(T.om(spark, d), T.os_(spark, d), "o_orderkey")


@query("replace_merge_keyless", _with(T.LM_STATUS, T.LS_STATUS) + """
SELECT * FROM lm UNION ALL SELECT * FROM ls""")
def replace_merge_keyless(spark, d):
    """M1 on a keyless table (H1): plain append."""
    return M.merge_replace(T.lm_status(spark, d), T.ls_status(spark, d), None)


@query("replace_merge_multi", _with(T.OM, T.OS) + """
SELECT * FROM om
WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = om.o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM os WHERE os.o_custkey = om.o_custkey AND os.o_orderdate = om.o_orderdate)
UNION ALL SELECT * FROM os""")
def replace_merge_multi(spark, d):
    """M2: a main row clashing on any unique key set is replaced."""
    return M.merge_replace(T.om(spark, d), T.os_(spark, d), [["o_orderkey"], ["o_custkey", "o_orderdate"]])


_LATE = T.orders_cut_sql("ol", T.STATUS_MAIN[:1], 3.0)


def _four_orders(spark, d):
    """Main and three subs over all orders; the last sub is a later copy of a part of main."""
    return [T.om(spark, d), T.os_(spark, d), T.ot(spark, d), T.orders_cut(spark, d, T.STATUS_MAIN[:1], 3.0)]


def _held_later(name: str, *later: str) -> str:
    return " AND ".join(f"NOT EXISTS (SELECT 1 FROM {x} WHERE x.o_orderkey = {name}.o_orderkey) AND "
                        f"NOT EXISTS (SELECT 1 FROM {x} WHERE x.o_custkey = {name}.o_custkey AND x.o_orderpriority = {name}.o_orderpriority)"
                        for x in (f"{y} x" for y in later))


@query("replace_merge_multi_many", _with(T.OM, T.OS, T.OT, _LATE) + f"""
SELECT * FROM om WHERE {_held_later('om', 'os', 'ot', 'ol')}
UNION ALL SELECT * FROM os WHERE {_held_later('os', 'ot', 'ol')}
UNION ALL SELECT * FROM ot WHERE {_held_later('ot', 'ol')}
UNION ALL SELECT * FROM ol""")
def replace_merge_multi_many(spark, d):
    """M2/M7: three subs on two unique key sets; a row stays if no later tenant holds any of its keys."""
    return M.merge_all_table(_four_orders(spark, d), [["o_orderkey"], ["o_custkey", "o_orderpriority"]])


@query("append_merge", _with(T.orders_cut_sql("oa", ("F",)), T.orders_cut_sql("ob", ("O", "P"), 1.0)) + """
SELECT * FROM oa UNION ALL SELECT * FROM ob""")
def append_merge(spark, d):
    """M3: disjoint tenants appended; a clash would raise."""
    return M.merge_append(T.orders_cut(spark, d, ("F",)), T.orders_cut(spark, d, ("O", "P"), 1.0),
                          "o_orderkey", on_conflict="error")


@query("append_new_surrogate", _with(T.OM, T.OS) + f"""
SELECT * FROM om
UNION ALL
SELECT CAST({_max_sql('o_orderkey', 'om')} + row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS o_orderkey,
       o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM os""")
def append_new_surrogate(spark, d):
    """Sub rows appended without their surrogate; new ids follow main's max."""
    return M.append_new_surrogate(T.om(spark, d), T.os_(spark, d), "o_orderkey")


@query("insert_absent", _with(T.OM, T.OS) + """
SELECT * FROM om
UNION ALL SELECT * FROM os WHERE NOT EXISTS (SELECT 1 FROM om WHERE om.o_orderkey = os.o_orderkey)""")
def insert_absent(spark, d):
    """M4: sub rows only where main lacks the key."""
    return M.merge_absent(T.om(spark, d), T.os_(spark, d), "o_orderkey")


@query("insert_absent_many", _with(T.OM, T.OS, T.OT) + f"""
SELECT {OCOLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ord) AS rn FROM (
    SELECT *, 0 AS ord FROM om UNION ALL SELECT *, 1 FROM os UNION ALL SELECT *, 2 FROM ot) u) r
WHERE rn = 1""")
def insert_absent_many(spark, d):
    """M4 over several subs in one pass: the earliest tenant keeps each key."""
    return M.merge_all_table([T.om(spark, d), T.os_(spark, d), T.ot(spark, d)], "o_orderkey", first_wins=True)


@query("insert_absent_multi_many", _with(
    T.orders_cut_sql("oa", ("P",)), T.orders_cut_sql("ob", ("O", "P"), 1.0), T.orders_cut_sql("oc", ("F", "O"), 2.0), T.orders_cut_sql("od", ("F",), 3.0),
    f"ib AS (SELECT * FROM oa UNION ALL SELECT * FROM ob WHERE {_held_later('ob', 'oa')})",
    f"ic AS (SELECT * FROM ib UNION ALL SELECT * FROM oc WHERE {_held_later('oc', 'ib')})") + f"""
SELECT * FROM ic UNION ALL SELECT * FROM od WHERE {_held_later('od', 'ic')}""")
def insert_absent_multi_many(spark, d):
    """M4 over three subs on two unique key sets: a row that was not inserted keeps no later one out."""
    frames = [T.orders_cut(spark, d, s, float(k)) for k, s in enumerate((("P",), ("O", "P"), ("F", "O"), ("F",)))]
    return M.merge_absent_all(frames[0], frames[1:], [["o_orderkey"], ["o_custkey", "o_orderpriority"]])


_NAMED = _with(T.CM, T.CS, T.CT, *(f"n{k} AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) * {k + 2} % {m} AS name FROM {t})"
                                   for k, (t, m) in enumerate((("cm", 11), ("cs", 29), ("ct", 53)))))


@query("insert_absent_names", _NAMED + """
SELECT id, name FROM n0
UNION ALL SELECT id, name FROM n1 WHERE name NOT IN (SELECT name FROM n0)
UNION ALL SELECT id, name FROM n2 WHERE name NOT IN (SELECT name FROM n0) AND name NOT IN (SELECT name FROM n1)""")
def insert_absent_names(spark, d):
    """M4 over two subs whose names repeat: all rows of the first tenant that holds a name stay."""
    frames = [t.select(F.col("c_custkey").alias("id"), (F.col("c_nationkey").cast("long") * (k + 2) % m).alias("name"))
              for k, (t, m) in enumerate(((T.cm(spark, d), 11), (T.cs(spark, d), 29), (T.ct(spark, d), 53)))]
    return M.merge_absent_all(frames[0], frames[1:], "name")


@query("filtered_merge", _with(T.OM, T.OS, "osf AS (SELECT * FROM os WHERE o_totalprice > 100000)") + """
SELECT * FROM om WHERE NOT EXISTS (SELECT 1 FROM osf WHERE osf.o_orderkey = om.o_orderkey)
UNION ALL SELECT * FROM osf""")
def filtered_merge(spark, d):
    """Only sub orders above a price are merged."""
    res = J.filtered_merge(T.main_tenant(spark, d, ("orders",)), [T.sub_tenant(spark, d, ("orders",))],
                           {"orders": "o_totalprice > 100000"})
    return res.main.table("orders")


def _exclusion_setup(spark, d):
    main = Tenant("main", 1, {"customer": T.cm(spark, d), "orders": T.om(spark, d),
                              "part": T.part_cut(spark, d, hi=25)}, T.SPECS)
    sub = Tenant("sub", 2, {"customer": T.cs(spark, d), "orders": T.os_(spark, d),
                            "part": T.part_cut(spark, d, lo=25), "nation": T.read(spark, d, "nation")}, T.SPECS)
    return main, sub


_EXCL_CTES = (T.CM, T.CS, T.OM, T.OS, T.part_cut_sql("pm", hi=25), T.part_cut_sql("ps", lo=25),
              "cmerged AS (SELECT * FROM cm WHERE NOT EXISTS (SELECT 1 FROM cs WHERE cs.c_custkey = cm.c_custkey) "
              "UNION ALL SELECT * FROM cs)",
              "omerged AS (SELECT * FROM om WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = om.o_orderkey) "
              "UNION ALL SELECT * FROM os)")


@query("exclude_merge", _with(*_EXCL_CTES) + """
SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS out_rows FROM cmerged
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM omerged
UNION ALL SELECT 'part', CAST(count(*) AS BIGINT) FROM pm""")
def exclude_merge(spark, d):
    """M6/R2: all tables but an exclusion list; a table main lacks is skipped."""
    main, sub = _exclusion_setup(spark, d)
    res = J.exclusion_merge(main, [sub], exclude=["part"])
    parts = [res.main.table(t).agg(F.count(F.lit(1)).cast("bigint").alias("out_rows"))
             .select(F.lit(t).alias("table_name"), "out_rows") for t in sorted(res.main.names())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("merge_lineage", _with(*_EXCL_CTES, "r AS (" + """
SELECT 'customer' AS table_name, 'merged' AS action, (SELECT count(*) FROM cm) AS main_rows,
       (SELECT count(*) FROM cs) AS sub_rows, (SELECT count(*) FROM cmerged) AS out_rows
UNION ALL SELECT 'orders', 'merged', (SELECT count(*) FROM om), (SELECT count(*) FROM os), (SELECT count(*) FROM omerged)
UNION ALL SELECT 'part', 'excluded', (SELECT count(*) FROM pm), (SELECT count(*) FROM ps), (SELECT count(*) FROM pm)
UNION ALL SELECT 'nation', 'missing', 0, (SELECT count(*) FROM nation), 0)""") + """
SELECT 'sub' AS tenant, table_name, action, CAST(main_rows AS BIGINT) AS main_rows, CAST(sub_rows AS BIGINT) AS sub_rows,
       CAST(out_rows AS BIGINT) AS out_rows,
       CAST(CASE WHEN action = 'merged' THEN main_rows + sub_rows - out_rows ELSE 0 END AS BIGINT) AS rows_replaced FROM r""")
def merge_lineage(spark, d):
    """Per-table report of a whole-tenant merge."""
    main, sub = _exclusion_setup(spark, d)
    merged, actions = M.merge_tenant(main, sub, exclude=["part"])
    return merge_report(main, sub, merged, actions)


@query("many_tenants", _with(T.OM, T.OS, T.OT) + f"""
SELECT {OCOLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ord DESC) AS rn FROM (
    SELECT *, 0 AS ord FROM om UNION ALL SELECT *, 1 FROM os UNION ALL SELECT *, 2 FROM ot) u) r
WHERE rn = 1""")
def many_tenants(spark, d):
    """M7: three tenants in order, the last one wins per key (one shuffle)."""
    return M.merge_all_table([T.om(spark, d), T.os_(spark, d), T.ot(spark, d)], "o_orderkey")


@query("account_merge", _with(T.CM, T.CS,
                              "am AS (SELECT c_custkey AS id, c_name AS username, c_acctbal AS balance FROM cm)",
                              "asb AS (SELECT c_custkey AS id, CASE WHEN c_name LIKE '%0' THEN c_name "
                              "ELSE c_name || '0' END AS username, c_acctbal AS balance FROM cs)") + """
SELECT * FROM am WHERE NOT EXISTS (SELECT 1 FROM asb WHERE asb.id = am.id)
UNION ALL SELECT * FROM asb""")
def account_merge(spark, d):
    """M8: account table found by candidate names, suffix unless present, then merged."""
    def acc(df):
        return df.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
                         F.col("c_acctbal").alias("balance"))
    main = Tenant("main_acc", 1, {"account": acc(T.cm(spark, d))}, {"account": "id"})
    sub = Tenant("sub_acc", 2, {"account": acc(T.cs(spark, d))}, {"account": "id"})
    return M.merge_accounts(main, sub, "0").table("account")


# ===================================================================== keys
@query("max_ids", _with(T.CM, T.CS, T.OM, T.OS) + """
SELECT 'main' AS tenant, 'customer' AS table_name, 'c_custkey' AS column_name,
       CAST(COALESCE(MAX(c_custkey), 0) AS BIGINT) AS max_id FROM cm
UNION ALL SELECT 'main', 'orders', 'o_orderkey', CAST(COALESCE(MAX(o_orderkey), 0) AS BIGINT) FROM om
UNION ALL SELECT 'main', 'orders', 'o_custkey', CAST(COALESCE(MAX(o_custkey), 0) AS BIGINT) FROM om
UNION ALL SELECT 'sub', 'customer', 'c_custkey', CAST(COALESCE(MAX(c_custkey), 0) AS BIGINT) FROM cs
UNION ALL SELECT 'sub', 'orders', 'o_orderkey', CAST(COALESCE(MAX(o_orderkey), 0) AS BIGINT) FROM os
UNION ALL SELECT 'sub', 'orders', 'o_custkey', CAST(COALESCE(MAX(o_custkey), 0) AS BIGINT) FROM os""")
def max_ids(spark, d):
    """K1: one aggregate per (tenant, table) over all its id columns."""
    return K.max_ids_frame([T.main_tenant(spark, d), T.sub_tenant(spark, d)],
                           [("customer", "c_custkey"), ("orders", "o_orderkey"), ("orders", "o_custkey")])


@query("shift_offset", _with(T.OM, T.OS) + f"""
SELECT {_shift_sql('o_orderkey', _max_sql('o_orderkey', 'om', 'os'))} AS o_orderkey,
       o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM os""")
def shift_offset(spark, d):
    """K2: sub keys > 0 move above both tenants' max; 0 stays (H3)."""
    main, sub = T.main_tenant(spark, d, ("orders",)), T.sub_tenant(spark, d, ("orders",))
    off = K.max_ids([main, sub], [("orders", "o_orderkey")])[("orders", "o_orderkey")]
    return K.shift(sub.table("orders"), "o_orderkey", off)


_COFF = _max_sql("c_custkey", "cm", "cs")


@query("shift_group", _with(T.CM, T.CS, T.OM, T.OS) + f"""
SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name FROM
  (SELECT o_orderkey, {_shift_sql('o_custkey', _COFF)} AS o_custkey FROM os) o
LEFT JOIN (SELECT {_shift_sql('c_custkey', _COFF)} AS c_custkey, c_name FROM cs) c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT o_orderkey, o_custkey, c_custkey, c_name FROM om LEFT JOIN cm ON o_custkey = c_custkey""")
def shift_group(spark, d):
    """K3: customer key and its FK share the offset of the group's first member."""
    main, sub = T.main_tenant(spark, d), T.sub_tenant(spark, d)
    grp = [("customer", "c_custkey"), ("orders", "o_custkey")]
    sub2 = K.shift_group(sub, grp, K.group_offset(main, sub, grp))
    out = None
    for t in (sub2, main):
        o, c = t.table("orders").select("o_orderkey", "o_custkey"), t.table("customer").select("c_custkey", "c_name")
        part = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
        out = part if out is None else out.unionByName(part)
    return out


@query("shift_each", _with(T.part_cut_sql("pm", hi=30), T.part_cut_sql("ps", lo=20),
                           T.supplier_cut_sql("sm", hi=15), T.supplier_cut_sql("ss", lo=10)) + f"""
SELECT 'part' AS table_name, {_shift_sql('p_partkey', _max_sql('p_partkey', 'pm', 'ps'))} AS id, p_name AS name FROM ps
UNION ALL
SELECT 'supplier', {_shift_sql('s_suppkey', _max_sql('s_suppkey', 'sm', 'ss'))}, s_name FROM ss""")
def shift_each(spark, d):
    """K4: each id column gets its own offset."""
    main = Tenant("main", 1, {"part": T.part_cut(spark, d, hi=30), "supplier": T.supplier_cut(spark, d, hi=15)})
    sub = Tenant("sub", 2, {"part": T.part_cut(spark, d, lo=20), "supplier": T.supplier_cut(spark, d, lo=10)})
    sub2, _ = K.shift_each(main, sub, [("part", "p_partkey"), ("supplier", "s_suppkey")])
    p = sub2.table("part").select(F.lit("part").alias("table_name"), F.col("p_partkey").alias("id"),
                                  F.col("p_name").alias("name"))
    s = sub2.table("supplier").select(F.lit("supplier").alias("table_name"), F.col("s_suppkey").alias("id"),
                                      F.col("s_name").alias("name"))
    return p.unionByName(s)


@query("renumber", _with(T.OM, T.OS) + """
SELECT 1 AS zone, o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) AS BIGINT) AS o_custkey FROM om
UNION ALL
SELECT 2, o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) AS BIGINT) FROM os""")
def renumber(spark, d):
    """K5: customer ids in orders renumbered 1..n per tenant (two-level rank)."""
    out = []
    for t in (T.main_tenant(spark, d, ("orders",)), T.sub_tenant(spark, d, ("orders",))):
        r = K.renumber(t, [("orders", "o_custkey")]).table("orders")
        out.append(r.select(F.lit(t.zone).alias("zone"), "o_orderkey", "o_custkey"))
    return out[0].unionByName(out[1])


_OOFF = _max_sql("o_orderkey", "om", "os")


@query("shift_polymorphic", _with(T.CM, T.CS, T.OM, T.OS) + f"""
SELECT o_orderkey,
       o_custkey + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {_COFF} ELSE 0 END
                 + CASE WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN {_OOFF} ELSE 0 END AS o_custkey,
       o_orderpriority
FROM os""")
def shift_polymorphic(spark, d):
    """K6/P10: the owner column moves by the offset of the type its row points to;
    rules run in order, the second sees the first's result."""
    main, sub = T.main_tenant(spark, d), T.sub_tenant(spark, d)
    offs = K.max_ids([main, sub], [("customer", "c_custkey"), ("orders", "o_orderkey")])
    o = sub.table("orders")
    o = K.shift_when(o, "o_custkey", offs[("customer", "c_custkey")], "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
    o = K.shift_when(o, "o_custkey", offs[("orders", "o_orderkey")], "where o_orderpriority IN ('2-HIGH', '5-LOW')")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority")


@query("shift_tokens", _with(T.CM, T.CS,
                             "valid AS (SELECT DISTINCT c_custkey AS id FROM cs WHERE c_custkey > 0)",
                             "toks AS (SELECT c_custkey, unnest(string_split(c_name, '#')) AS tok, "
                             "generate_subscripts(string_split(c_name, '#'), 1) AS pos FROM cs WHERE c_name IS NOT NULL)",
                             f"rebuilt AS (SELECT t.c_custkey, string_agg(CASE WHEN v.id IS NOT NULL THEN "
                             f"CAST(v.id + {_COFF} AS VARCHAR) ELSE t.tok END, '#' ORDER BY t.pos) AS c_name "
                             f"FROM toks t LEFT JOIN valid v ON TRY_CAST(t.tok AS BIGINT) = v.id GROUP BY t.c_custkey)") + f"""
SELECT {_shift_sql('cs.c_custkey', _COFF)} AS c_custkey, r.c_name, cs.c_nationkey, cs.c_acctbal, cs.c_mktsegment
FROM cs LEFT JOIN rebuilt r ON r.c_custkey = cs.c_custkey""")
def shift_tokens(spark, d):
    """K7: customer numbers written inside the name move with the customer id,
    token by token and only when they name an existing sub customer."""
    main, sub = T.main_tenant(spark, d, ("customer",)), T.sub_tenant(spark, d, ("customer",))
    off = K.group_offset(main, sub, [("customer", "c_custkey")])
    c = sub.table("customer")
    c = K.shift_tokens(c, "c_name", off, "#", valid_ids=c.select("c_custkey"), row_key="c_custkey")
    return K.shift(c, "c_custkey", off)


@query("shift_associated", _with(T.CM, T.CS, T.OM, T.OS) + f"""
SELECT o_orderkey, {_shift_sql('o_custkey', _COFF)} AS o_custkey, o_orderstatus FROM os
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM om""")
def shift_associated(spark, d):
    """K8: a declared id and every column named like its associated name share one offset."""
    main, sub = T.main_tenant(spark, d), T.sub_tenant(spark, d)
    sub2, _ = K.shift_associated(main, sub, [{"db_table": "customer", "db_field": "c_custkey",
                                              "associated": "o_custkey"}])
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    return sub2.table("orders").select(*cols).unionByName(main.table("orders").select(*cols))


@query("shift_by_name", _with(T.OM, T.OS, T.lines_of_sql("lm", "om"), T.lines_of_sql("ls", "os")) + f"""
SELECT {_shift_sql('l_orderkey', _max_sql('l_orderkey', 'lm', 'ls'))} AS l_orderkey,
       l_partkey, l_suppkey, l_linenumber, l_quantity FROM ls""")
def shift_by_name(spark, d):
    """K9: every table having a named key column shifts it by that table's own max."""
    main = T.main_tenant(spark, d, ("orders", "lineitem"))
    sub = T.sub_tenant(spark, d, ("orders", "lineitem"))
    sub2, _ = K.shift_by_column_name(main, sub, ["o_orderkey", "l_orderkey"])
    return sub2.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


_ZONE_BY_STATUS = "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER)"


@query("zone_of_guid", f"""
SELECT o_orderkey, (CAST({_ZONE_BY_STATUS} AS BIGINT) << 54) + o_orderkey AS guid,
       ((CAST({_ZONE_BY_STATUS} AS BIGINT) << 54) + o_orderkey) >> 54 AS zone
FROM orders""")
def zone_of_guid_q(spark, d):
    """Tenant number packed in the top 10 bits of a guid and read back."""
    o = T.read(spark, d, "orders").withColumn("z", F.expr(_ZONE_BY_STATUS))
    o = o.withColumn("guid", make_guid("z", "o_orderkey"))
    return o.select("o_orderkey", "guid", zone_of_guid("guid").alias("zone"))



# ===================================================================== rows
@query("set_const", """
SELECT o_orderkey, o_custkey, 'M' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def set_const(spark, d):
    """A column set on every row."""
    return P.set_const(T.read(spark, d, "orders"), {"o_orderstatus": "M"})


@query("set_where", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice < 50000 THEN '3-MEDIUM' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def set_where(spark, d):
    """A column set where a predicate holds."""
    return P.set_where(T.read(spark, d, "orders"), "o_totalprice < 50000", {"o_orderpriority": "3-MEDIUM"})


@query("map_values", _with(T.OM, T.OS) + """
SELECT zone, o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '3-MEDIUM'
                              ELSE o_orderpriority END AS o_orderpriority
FROM (SELECT 1 AS zone, * FROM om UNION ALL SELECT 2, * FROM os) u""")
def map_values(spark, d):
    """Value pairs applied in order on main and sub (1-URGENT -> 2-HIGH -> 3-MEDIUM)."""
    out = []
    for zone, o in ((1, T.om(spark, d)), (2, T.os_(spark, d))):
        m = P.map_values(o, "o_orderpriority", {"1-URGENT": "2-HIGH", "2-HIGH": "3-MEDIUM"})
        out.append(m.select(F.lit(zone).alias("zone"), "o_orderkey", "o_orderpriority"))
    return out[0].unionByName(out[1])


@query("stamp_zone", """
SELECT c_custkey, c_name, CAST(99 AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment, 2 AS zone_id FROM customer""")
def stamp_zone(spark, d):
    """Server-id column stamped with the tenant id, lineage column added."""
    return P.with_zone(P.stamp_tenant(T.read(spark, d, "customer"), ["c_nationkey"], 99), 2)


@query("widen", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def widen(spark, d):
    """Id column widened to bigint."""
    return P.widen(T.read(spark, d, "customer"), ["c_nationkey"])


@query("delete_where", """
SELECT * FROM orders WHERE COALESCE(NOT (o_totalprice > 300000), TRUE)""")
def delete_where(spark, d):
    """Rows matching a predicate deleted (a NULL predicate keeps the row)."""
    return P.delete_where(T.read(spark, d, "orders"), "o_totalprice > 300000")


@query("empty_table", _with(T.OT) + f"SELECT {OCOLS} FROM ot")
def empty_table(spark, d):
    """main's table emptied by the append job, a third tenant's rows appended to what is left."""
    main = Tenant("main", 1, {"orders": T.om(spark, d).unionByName(T.os_(spark, d))}, T.SPECS)
    emptied = J.append_reconcile(main, [T.sub_tenant(spark, d, ("orders",))], {"append": {"orders": "empty"}}).main
    return M.merge_append(emptied.table("orders"), T.ot(spark, d), "o_orderkey")


# ==================================================================== names
@query("affix_all", """
SELECT c_custkey, CASE WHEN c_name <> 'Customer#000000007' THEN 's2_' || c_name ELSE c_name END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def affix_all(spark, d):
    """Prefix on every name except the skip value."""
    return N.affix(T.read(spark, d, "customer"), "c_name", "s2_", "prefix", skip="Customer#000000007")


@query("affix_conflicts", _with(T.CM, T.CS) + """
SELECT c_custkey, CASE WHEN c_name IN (SELECT c_name FROM cm) AND c_name <> '' THEN c_name || '_2'
                       ELSE c_name END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment FROM cs""")
def affix_conflicts(spark, d):
    """Suffix only on names that already exist in main."""
    return N.affix_conflicts(T.cs(spark, d), T.cm(spark, d), "c_name", "_2", "suffix", skip="")


@query("affix_idempotent", """
SELECT c_custkey, CASE WHEN c_name LIKE '%0' THEN c_name ELSE c_name || '0' END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def affix_idempotent(spark, d):
    """Account suffix unless the name already ends with it."""
    return N.affix(T.read(spark, d, "customer"), "c_name", "0", "suffix", idempotent=True)


@query("tenant_prefix", """
SELECT c_custkey, 's2' || c_name AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def tenant_prefix(spark, d):
    """Names prefixed with s<zone>."""
    return N.tenant_prefix(T.read(spark, d, "customer"), "c_name", 2)


def _parts_appended(spark, d) -> DataFrame:
    pm = T.part_cut(spark, d, hi=25).select("p_partkey", "p_name", F.lit(1).alias("zone"))
    ps = T.part_cut(spark, d, lo=25).select("p_partkey", "p_name", F.lit(2).alias("zone"))
    return M.merge_append(pm, ps, "p_partkey")


_PARTS_U = ("u AS (SELECT p_partkey, p_name, 1 AS zone FROM part WHERE p_size <= 25 "
            "UNION ALL SELECT p_partkey, p_name, 2 FROM part WHERE p_size > 25)")
_PARTS_DUP = "dup AS (SELECT p_name FROM u WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(p_name) > 1)"
_PARTS_REN = ("ren AS (SELECT p_partkey, p_name AS old_name, 's' || CAST(zone AS VARCHAR) || '.' || p_name AS new_name, "
              "zone FROM u WHERE p_name IN (SELECT p_name FROM dup) AND zone <> 1 AND p_partkey <> 0)")


@query("rename_duplicates", _with(_PARTS_U, _PARTS_DUP, _PARTS_REN) + """
SELECT u.p_partkey, COALESCE(ren.new_name, u.p_name) AS p_name, u.zone
FROM u LEFT JOIN ren ON ren.p_partkey = u.p_partkey""")
def rename_duplicates(spark, d):
    """After an append, duplicated names outside the main zone become s<zone>.<name>."""
    renamed, _ = N.rename_duplicates(_parts_appended(spark, d), "p_name", "zone", 1, id_col="p_partkey")
    return renamed


@query("rename_guilds", _with("g AS (SELECT (CAST(CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS BIGINT) << 54) "
                              "+ p_partkey AS guid, p_name AS name FROM part)",
                              "dup AS (SELECT name FROM g WHERE name IS NOT NULL GROUP BY name HAVING count(name) > 1)") + """
SELECT guid, CASE WHEN name IN (SELECT name FROM dup) AND (guid >> 54) <> 1 AND guid <> 0
                  THEN 's' || CAST(guid >> 54 AS VARCHAR) || '.' || name ELSE name END AS name
FROM g""")
def rename_guilds(spark, d):
    """Guild renames with the zone read from the guid's top bits."""
    p = T.read(spark, d, "part")
    g = p.select(make_guid(F.when(F.col("p_size") <= 25, 1).otherwise(2), "p_partkey").alias("guid"),
                 F.col("p_name").alias("name"))
    renamed, _ = N.rename_guilds(g, "name", "guid", 1)
    return renamed


@query("guild_ledger", _with("g AS (SELECT (CAST(CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS BIGINT) << 54) "
                             "+ p_partkey AS guid, p_name AS name, p_partkey FROM part)",
                             "dup AS (SELECT name FROM g WHERE name IS NOT NULL GROUP BY name HAVING count(name) > 1)",
                             "lead AS (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem WHERE l_linenumber = 1 GROUP BY l_partkey)") + """
SELECT CAST(s AS BIGINT) AS guid, 'leader' || CAST(s AS VARCHAR) AS name, CAST(2 AS INTEGER) AS type
FROM g JOIN lead ON p_partkey = l_partkey
WHERE name IN (SELECT name FROM dup) AND (guid >> 54) <> 1 AND guid <> 0""")
def guild_ledger(spark, d):
    """A compensation row for the leader of every renamed guild; line items stand for members, their first for leaders."""
    p = T.read(spark, d, "part").withColumn("guid", make_guid(F.when(F.col("p_size") <= 25, 1).otherwise(2), "p_partkey"))
    _, renames = N.rename_guilds(p.select("guid", F.col("p_name").alias("name")), "name", "guid", 1)
    members = T.read(spark, d, "lineitem").join(p.select(F.col("p_partkey").alias("l_partkey"), F.col("guid").alias("guildid")), "l_partkey")
    members = members.select("guildid", F.col("l_suppkey").alias("guid"), F.concat(F.lit("leader"), F.col("l_suppkey").cast("string")).alias("name"),
                             F.when(F.col("l_linenumber") == 1, 13).otherwise(1).alias("post"))
    return N.guild_ledger(renames, members)


@query("cascade_rename", _with(_PARTS_U, _PARTS_DUP, _PARTS_REN) + """
SELECT COALESCE(ren.new_name, p.p_name) AS p_name, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN ren ON ren.p_partkey = l.l_partkey
GROUP BY 1""")
def cascade_rename(spark, d):
    """New part names propagated to line items that carry a copy of the name."""
    _, renames = N.rename_duplicates(_parts_appended(spark, d), "p_name", "zone", 1, id_col="p_partkey")
    li = T.read(spark, d, "lineitem").select("l_partkey", "l_quantity")
    child = li.join(T.read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    child = N.cascade(child, "l_partkey", "p_name", renames)
    return child.groupBy("p_name").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum(_dec("l_quantity")).cast("double").alias("qty"))


@query("rename_ledger", _with(_PARTS_U, _PARTS_DUP, _PARTS_REN) + """
SELECT CAST(p_partkey AS BIGINT) AS guid, new_name AS name, CAST(1 AS INTEGER) AS type FROM ren""")
def rename_ledger(spark, d):
    """One compensation row per rename."""
    _, renames = N.rename_duplicates(_parts_appended(spark, d), "p_name", "zone", 1, id_col="p_partkey")
    return N.rename_ledger(renames, 1)


# ================================================================= identity
@query("relink_accounts", _with(T.CM, T.CS, T.OS,
                                f"css AS (SELECT {_shift_sql('c_custkey', _COFF)} AS c_custkey, c_name FROM cs)",
                                f"oss AS (SELECT o_orderkey, {_shift_sql('o_custkey', _COFF)} AS o_custkey FROM os)",
                                "mp AS (SELECT s.c_custkey AS sub_id, m.c_custkey AS main_id FROM css s "
                                "JOIN cm m ON s.c_name = m.c_name WHERE m.c_custkey <> 0 AND s.c_custkey <> 0)") + """
SELECT o_orderkey, COALESCE(mp.main_id, oss.o_custkey) AS o_custkey FROM oss LEFT JOIN mp ON oss.o_custkey = mp.sub_id""")
def relink_accounts(spark, d):
    """After the id shift, sub orders of a customer whose name exists in main
    point at main's customer id."""
    main, sub = T.main_tenant(spark, d), T.sub_tenant(spark, d)
    grp = [("customer", "c_custkey"), ("orders", "o_custkey")]
    sub2 = K.shift_group(sub, grp, K.group_offset(main, sub, grp))
    _, kids = I.relink_accounts(main.table("customer"), sub2.table("customer"), "c_custkey", "c_name",
                                {"orders": (sub2.table("orders"), "o_custkey")})
    return kids["orders"].select("o_orderkey", "o_custkey")


_SURV_ORDER = "ORDER BY CASE WHEN zone = 1 THEN 0 ELSE 1 END, value DESC, event_id"


@query("survivors", _with(T.EVENTS_ZONED) + f"""
SELECT event_id, ts, user_id, event_type, value, props, zone FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id {_SURV_ORDER}) AS rn FROM ez) r WHERE rn = 1""")
def survivors(spark, d):
    """One row per user: main-zone rows first, then highest value, then id."""
    return I.survivors(T.events_zoned(spark, d), "user_id", [("value", "desc"), "event_id"],
                       prefer=F.col("zone") == 1)


_EF = (f"e AS (SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, "
       f"CAST(floor(value / 10) AS BIGINT) AS tickets, props, {T.EVENT_ZONE_SQL} AS zone FROM events)")


def _events_fold_input(spark, d) -> DataFrame:
    return T.events_zoned(spark, d).select(
        "event_id", "ts", "user_id", "event_type", _dec("value").alias("value"),
        F.floor(F.col("value") / 10).cast("bigint").alias("tickets"), "props", "zone")


@query("fold_accounts", _with(_EF,
                              f"s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id {_SURV_ORDER}) rn "
                              f"FROM e) r WHERE rn = 1)",
                              "a AS (SELECT user_id, count(*) AS n, COALESCE(SUM(value), 0) AS sv, MIN(ts) AS mts, "
                              "MAX(event_type) AS met, LEAST(COALESCE(SUM(tickets), 0), 200) AS st FROM e GROUP BY user_id)") + """
SELECT s.event_id, CASE WHEN a.n > 1 THEN a.mts ELSE s.ts END AS ts, s.user_id,
       CASE WHEN a.n > 1 THEN a.met ELSE s.event_type END AS event_type,
       CAST(CASE WHEN a.n > 1 THEN a.sv ELSE s.value END AS DOUBLE) AS value,
       CAST(CASE WHEN a.n > 1 THEN a.st ELSE s.tickets END AS BIGINT) AS tickets, s.props, s.zone
FROM s JOIN a ON a.user_id = s.user_id""")
def fold_accounts(spark, d):
    """Duplicates of a user folded into its survivor (SUM, MIN, MAX, capped SUM)."""
    f = I.fold(_events_fold_input(spark, d), "user_id", [("value", "desc"), "event_id"],
               {"value": "sum", "ts": "min", "event_type": "max", "tickets": ("sum_capped", 200)},
               prefer=F.col("zone") == 1)
    return f.withColumn("value", F.col("value").cast("double"))


@query("sum_to_first", """
SELECT MIN(event_id) AS event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY user_id""")
def sum_to_first(spark, d):
    """Smallest id survives with the summed amount."""
    e = T.read(spark, d, "events").select("event_id", "user_id", _dec("value").alias("value"))
    return I.fold(e, "user_id", ["event_id"], {"value": "sum"}, only_duplicates=False) \
        .withColumn("value", F.col("value").cast("double"))


@query("max_to_first", """
SELECT MIN(event_id) AS event_id, user_id, event_type, MAX(value) AS value FROM events GROUP BY user_id, event_type""")
def max_to_first(spark, d):
    """Per composite key the smallest id survives with the maximum."""
    e = T.read(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return I.fold(e, ["user_id", "event_type"], ["event_id"], {"value": "max"}, only_duplicates=False)


_ORD_ZONE = "CAST(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END AS INTEGER)"
_ORD_ZONE_SPARK = _ORD_ZONE.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")


@query("tie_classes", _with(f"a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, {_ORD_ZONE} AS zone "
                            "FROM orders)",
                            "g AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS ds, "
                            "count(DISTINCT o_orderpriority) AS dp FROM a GROUP BY o_custkey)",
                            "ka AS (SELECT a.o_orderkey FROM a JOIN g ON g.o_custkey = a.o_custkey "
                            "WHERE g.n > 1 AND g.ds = 1 AND g.dp = 1 AND a.zone = 1)",
                            "kb AS (SELECT o_orderkey FROM (SELECT a.o_orderkey, row_number() OVER (PARTITION BY a.o_custkey "
                            "ORDER BY a.o_orderstatus DESC, a.o_orderpriority DESC, a.o_orderkey) AS rn FROM a "
                            "JOIN g ON g.o_custkey = a.o_custkey WHERE g.n = 1 OR (g.n > 1 AND g.ds > 1 OR g.dp > 1)) r "
                            "WHERE rn = 1)") + """
SELECT o_orderkey FROM ka UNION ALL SELECT o_orderkey FROM kb""")
def tie_classes(spark, d):
    """Duplicates that agree keep the main-zone row, the rest keep the best row."""
    a = T.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                          F.expr(_ORD_ZONE_SPARK).alias("zone"))
    return I.tie_classes(a, "o_custkey", ["o_orderstatus", "o_orderpriority"], "zone", 1, "o_orderkey")


@query("repoint_fk", _with("s AS (SELECT c_nationkey, c_mktsegment, c_custkey AS keep FROM (SELECT *, row_number() OVER "
                           "(PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn "
                           "FROM customer) r WHERE rn = 1)",
                           "m AS (SELECT c.c_custkey AS k, s.keep FROM customer c JOIN s "
                           "ON s.c_nationkey = c.c_nationkey AND s.c_mktsegment = c.c_mktsegment)") + """
SELECT o_orderkey, COALESCE(m.keep, o_custkey) AS o_custkey FROM orders LEFT JOIN m ON orders.o_custkey = m.k""")
def repoint_fk(spark, d):
    """I8: orders re-pointed to the surviving customer of their (nation, segment)."""
    c = T.read(spark, d, "customer")
    surv = I.survivor_ids(c, ["c_nationkey", "c_mktsegment"], [("c_acctbal", "desc"), "c_custkey"], "c_custkey")
    keep = c.select("c_nationkey", "c_mktsegment", "c_custkey").join(surv, ["c_nationkey", "c_mktsegment"]).select(F.col("c_custkey").alias("key"), "keep")
    return I.repoint(T.read(spark, d, "orders"), "o_custkey", "o_custkey", keep).select("o_orderkey", "o_custkey")


@query("delete_orphans", _with(T.CM) + """
SELECT * FROM orders WHERE NOT (o_orderpriority = '1-URGENT')
   OR EXISTS (SELECT 1 FROM cm WHERE cm.c_custkey = orders.o_custkey)""")
def delete_orphans(spark, d):
    """Urgent orders whose customer is not kept are deleted."""
    return I.delete_orphans(T.read(spark, d, "orders"), "o_custkey", T.cm(spark, d).select("c_custkey"),
                            only="o_orderpriority = '1-URGENT'")


@query("delete_losers", _with(T.EVENTS_ZONED,
                              f"k AS (SELECT user_id, event_id AS keep FROM (SELECT *, row_number() OVER "
                              f"(PARTITION BY user_id {_SURV_ORDER}) AS rn FROM ez) r WHERE rn = 1)") + """
SELECT ez.* FROM ez LEFT JOIN k ON k.user_id = ez.user_id
WHERE NOT (k.user_id IS NOT NULL AND ez.event_type = 'purchase' AND ez.event_id <> k.keep)""")
def delete_losers(spark, d):
    """Purchase rows not owned by the user's survivor are deleted."""
    e = T.events_zoned(spark, d)
    keep = I.survivor_ids(e, "user_id", [("value", "desc"), "event_id"], "event_id", prefer=F.col("zone") == 1)
    keep = keep.withColumnRenamed("user_id", "key")
    return I.delete_losers(e, "user_id", "event_id", keep, only="event_type = 'purchase'")


_ACC = (f"acc AS (SELECT MIN(event_id) AS guid, user_id AS accid, zone AS zone_id FROM "
        f"(SELECT event_id, user_id, {T.EVENT_ZONE_SQL} AS zone FROM events) x GROUP BY user_id, zone)")
_REC = (f"rec AS (SELECT e.event_id, e.user_id AS owner, a.guid AS acc_guid, CAST(CASE e.event_type WHEN 'click' THEN 34 "
        f"WHEN 'purchase' THEN 70 ELSE 1 END AS INTEGER) AS shop_id FROM (SELECT *, {T.EVENT_ZONE_SQL} AS zone "
        f"FROM events) e JOIN acc a ON a.accid = e.user_id AND a.zone_id = e.zone)")


def _accounts_records(spark, d):
    e = T.events_zoned(spark, d)
    acc = e.groupBy("user_id", "zone").agg(F.min("event_id").alias("guid")) \
        .select("guid", F.col("user_id").alias("accid"), F.col("zone").alias("zone_id"))
    shop = F.when(F.col("event_type") == "click", 34).when(F.col("event_type") == "purchase", 70).otherwise(1)
    rec = e.join(acc, (e["user_id"] == acc["accid"]) & (e["zone"] == acc["zone_id"])) \
        .select("event_id", F.col("user_id").alias("owner"), F.col("guid").alias("acc_guid"),
                shop.cast("int").alias("shop_id"))
    hire = e.where(F.col("event_type") == "signup").select(F.col("user_id").alias("accid"))
    return acc, rec, hire


@query("keep_richer_side", _with(_ACC, _REC,
                                 "dup AS (SELECT user_id AS accid FROM events WHERE event_type = 'signup' "
                                 "GROUP BY user_id HAVING count(*) > 1)",
                                 "sides AS (SELECT accid, MIN(CASE WHEN zone_id = 1 THEN guid END) AS g1, "
                                 "MIN(CASE WHEN zone_id <> 1 THEN guid END) AS g2 FROM acc "
                                 "WHERE accid IN (SELECT accid FROM dup) GROUP BY accid)",
                                 "cnt AS (SELECT acc_guid, count(*) AS c FROM rec GROUP BY acc_guid)",
                                 "dcs AS (SELECT s.accid, CASE WHEN COALESCE(c1.c, 0) > COALESCE(c2.c, 0) THEN s.g2 "
                                 "ELSE s.g1 END AS lose FROM sides s LEFT JOIN cnt c1 ON c1.acc_guid = s.g1 "
                                 "LEFT JOIN cnt c2 ON c2.acc_guid = s.g2 WHERE s.g1 IS NOT NULL AND s.g2 IS NOT NULL "
                                 "AND s.g1 <> 0 AND s.g2 <> 0)") + """
SELECT * FROM rec WHERE NOT EXISTS (
  SELECT 1 FROM dcs WHERE dcs.accid = rec.owner AND dcs.lose = rec.acc_guid AND rec.shop_id = 34)""")
def keep_richer_side(spark, d):
    """For users with several signups, the side with fewer records loses its shop-34 rows."""
    acc, rec, hire = _accounts_records(spark, d)
    return I.keep_richer_side(hire, acc, rec, 1)


@query("collapse_counters", """
SELECT event_id, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value
FROM events WHERE NOT (event_type = 'view')
UNION ALL
SELECT MIN(event_id), user_id, 'view', CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
FROM events WHERE event_type = 'view' GROUP BY user_id""")
def collapse_counters(spark, d):
    """Counter rows of one type collapse to one row per owner with the sum."""
    e = T.read(spark, d, "events").select("event_id", "user_id", "event_type", _dec("value").alias("value"))
    return I.collapse_counters(e, "user_id", "value", "event_id", where="event_type = 'view'") \
        .withColumn("value", F.col("value").cast("double"))


# ================================================================ retention
_AS_OF = datetime(1999, 1, 1)


@query("purge_inactive", _with("last AS (SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders GROUP BY o_custkey)",
                               "purged AS (SELECT c.c_custkey FROM customer c LEFT JOIN last l ON l.o_custkey = c.c_custkey "
                               "WHERE c.c_acctbal < 1000 AND COALESCE(l.last_order < TIMESTAMP '1997-01-01 00:00:00', TRUE))") + """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM purged WHERE purged.c_custkey = orders.o_custkey)""")
def purge_inactive(spark, d):
    """Poor customers without an order since 1997 are deleted with their orders."""
    c = T.read(spark, d, "customer")
    o = T.read(spark, d, "orders")
    last = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_order"))
    ent = c.join(last, "c_custkey", "left")
    pred = (F.col("c_acctbal") < 1000) & F.coalesce(F.col("last_order") < F.lit("1997-01-01").cast("timestamp_ntz"),
                                                    F.lit(True))
    t = R.purge(Tenant("t", 1, {"customer": ent, "orders": o}), "customer", "c_custkey", pred, {"orders": "o_custkey"})
    return t.table("orders").select("o_orderkey", "o_custkey")


@query("purge_two_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 2)
  AND l_suppkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 2)""")
def purge_two_columns(spark, d):
    """Rows go when either of two id columns names a purged id."""
    purged = T.part_cut(spark, d, hi=2).select("p_partkey")
    li = T.read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return R.purge_children(li, ["l_partkey", "l_suppkey"], purged)


_CLEANING = {
    "state": "1", "level": "1000", "day": "700",
    "conditions": [
        {"type": "1", "db_table": "customer", "db_field": "c_acctbal", "common": "c_custkey"},
        {"type": "2", "db_table": "activity", "db_field": "last_order", "common": "c_custkey", "time_format": "1"},
    ],
    "cleaning_table": [{"db_table": "orders", "db_field": "o_custkey"}],
    "all_clear": [{"db_table": "orders", "db_field": "o_totalprice", "conditions": "< 1000"}],
}


@query("purge_from_spec", _with("act AS (SELECT o_custkey AS c_custkey, MAX(o_orderdate) AS last_order FROM orders "
                                "GROUP BY o_custkey)",
                                "purged AS (SELECT c_custkey FROM customer WHERE c_acctbal < 1000 INTERSECT "
                                "SELECT c_custkey FROM act WHERE last_order < TIMESTAMP '1999-01-01 00:00:00' - INTERVAL 700 DAY)") + """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM purged WHERE purged.c_custkey = orders.o_custkey)
  AND COALESCE(NOT (o_totalprice < 1000), TRUE)""")
def purge_from_spec(spark, d):
    """I16: declarative purge: low balance AND inactive, cascade, plus all_clear deletes."""
    o = T.read(spark, d, "orders")
    act = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_order"))
    t = Tenant("t", 1, {"customer": T.read(spark, d, "customer"), "orders": o, "activity": act})
    out = R.purge_from_spec(t, _CLEANING, _AS_OF)
    return out.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")


_RESET_IN = "u AS (SELECT *, 1 AS server FROM om UNION ALL SELECT *, 2 FROM os)"


@query("resets", _with(T.OM, T.OS, _RESET_IN,
                       "r1 AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END "
                       "AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, server FROM u)") + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'O' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority, 1 AS server
FROM r1 WHERE COALESCE(NOT (o_totalprice < 2000), TRUE)""")
def resets(spark, d):
    """Ordered reset rules after a merge, then every row to the main zone."""
    u = T.om(spark, d).withColumn("server", F.lit(1)).unionByName(T.os_(spark, d).withColumn("server", F.lit(2)))
    u = P.with_zone(u, 0).withColumn("zone_id", F.col("server"))
    t = R.reset(Tenant("t", 1, {"orders": u}), {"orders": [
        ("set", "o_orderstatus", "O", "o_orderstatus = 'P'"),
        ("set", "o_orderpriority", "5-LOW", "o_orderstatus = 'O'"),
        ("delete", "o_totalprice < 2000"),
    ]})
    return R.final_zone(t.table("orders"), ["server"], 1)


# ===================================================================== jobs
@query("relabel_merge", _with(T.CM, T.CS) + """
SELECT * FROM cm WHERE NOT EXISTS (SELECT 1 FROM cs WHERE cs.c_custkey = cm.c_custkey)
UNION ALL
SELECT c_custkey, 's2' || c_name, CASE WHEN c_nationkey = 2 THEN 1 ELSE c_nationkey END, c_acctbal, c_mktsegment
FROM cs""")
def relabel_merge(spark, d):
    """Sub names prefixed s<zone>, the sub's zone re-labelled to main's
    in the zone column (here c_nationkey), then merged."""
    res = J.relabel_merge(T.main_tenant(spark, d, ("customer",)), [T.sub_tenant(spark, d, ("customer",))],
                          name_cols=[("customer", "c_name")], zone_cols=[("customer", "c_nationkey")])
    return res.main.table("customer")


@query("relabel_outputs", _with(T.CM) + """
SELECT 'login' AS kind, CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_nationkey IN (2, 3) THEN 1 ELSE c_nationkey END AS zone FROM customer
UNION ALL SELECT 'config', CAST(c_custkey AS BIGINT), CASE WHEN c_custkey % 2 = 0 AND c_nationkey IN (2, 3) THEN 1 ELSE c_nationkey END FROM customer
UNION ALL SELECT 'record', 2, 1 UNION ALL SELECT 'record', 3, 1""")
def relabel_outputs(spark, d):
    """R4's side outputs over two subs: login servers re-pointed to main, server settings, one record per sub."""
    c = T.read(spark, d, "customer")
    login = Tenant("login", 0, {"t_login": c})
    config = Tenant("config", 0, {"t_server": c.select("c_custkey", F.col("c_nationkey").alias("serverId"), (F.col("c_custkey") % 2).alias("serverType"),
                                                       F.col("c_nationkey").alias("zone"))})
    subs = [Tenant("a", 2, {"customer": T.cs(spark, d)}, T.SPECS), Tenant("b", 3, {"customer": T.ct(spark, d)}, T.SPECS)]
    out = J.relabel_merge(T.main_tenant(spark, d, ("customer",)), subs, login=(login, "t_login", "c_nationkey"), merge_record=True,
                          server_config=(config, "t_server", {"zone": 1})).extra
    parts = [(out["login"].table("t_login"), "login", "c_custkey", "c_nationkey"), (out["server_config"].table("t_server"), "config", "c_custkey", "zone"),
             (out["t_merge_record"], "record", "fromServerId", "finalServerId")]
    rows = [df.select(F.lit(k).alias("kind"), F.col(i).cast("bigint").alias("id"), F.col(z).cast("int").alias("zone")) for df, k, i, z in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("exclude_merge_rows", _with(*_EXCL_CTES) + """
SELECT 'customer' AS table_name, CAST(c_custkey AS BIGINT) AS id, c_acctbal AS amount FROM cmerged
UNION ALL SELECT 'orders', CAST(o_orderkey AS BIGINT), o_totalprice FROM omerged
UNION ALL SELECT 'part', CAST(p_partkey AS BIGINT), p_retailprice FROM pm""")
def exclude_merge_rows(spark, d):
    """R2: the rows of every table after a merge with an exclusion list."""
    main, sub = _exclusion_setup(spark, d)
    res = J.exclusion_merge(main, [sub], exclude=["part"]).main
    cols = {"customer": ("c_custkey", "c_acctbal"), "orders": ("o_orderkey", "o_totalprice"), "part": ("p_partkey", "p_retailprice")}
    parts = [res.table(t).select(F.lit(t).alias("table_name"), F.col(k).cast("bigint").alias("id"), F.col(v).alias("amount")) for t, (k, v) in cols.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("append_reconcile", _with(_EF,
                                 "s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
                                 "ORDER BY CASE WHEN zone = 1 THEN 0 ELSE 1 END, value DESC, event_id) rn FROM e) r "
                                 "WHERE rn = 1)",
                                 "a AS (SELECT user_id, count(*) AS n, COALESCE(SUM(value), 0) AS sv, "
                                 "LEAST(COALESCE(SUM(tickets), 0), 200) AS st FROM e GROUP BY user_id)") + """
SELECT s.event_id, s.ts, s.user_id, s.event_type,
       CAST(CASE WHEN a.n > 1 THEN a.sv ELSE s.value END AS DOUBLE) AS value,
       CAST(CASE WHEN a.n > 1 THEN a.st ELSE s.tickets END AS BIGINT) AS tickets, s.props
FROM s JOIN a ON a.user_id = s.user_id""")
def append_reconcile(spark, d):
    """Three day-shards appended with lineage, accounts folded into one survivor each."""
    e = _events_fold_input(spark, d)
    tenants = [Tenant(f"z{z}", z, {"account": e.where(F.col("zone") == z).drop("zone")}, {"account": "event_id"})
               for z in (1, 2, 3)]
    spec = {"append": {"account": "error"},
            "accounts": {"table": "account", "key": "user_id", "id": "event_id",
                         "order": [("value", "desc"), "event_id"],
                         "folds": {"value": "sum", "tickets": ("sum_capped", 200)}}}
    res = J.append_reconcile(tenants[0], tenants[1:], spec)
    return res.main.table("account").withColumn("value", F.col("value").cast("double"))


_ACCT_EXPRS = ["event_id AS guid", "user_id AS accid", "event_type AS adventure_team_name",
               "CAST(floor(value / 100) AS INTEGER) AS adventure_team_level",
               "CAST(floor(value / 10) AS BIGINT) AS adventure_team_exp", "CAST(floor(value) AS BIGINT) AS point",
               "CAST(day(ts) AS BIGINT) AS reg_time"]
#: the other columns that are folded, each from the event's value in a way of its own
_ACCT_FOLDS = {c: kind for c, kind in ACCOUNT_FOLDS.items() if c not in ("point", "reg_time")}
_ACCT_EXPRS += [f"CAST(floor(value * {k}) % {90 + k} AS BIGINT) AS {c}" for k, c in enumerate(_ACCT_FOLDS, 2)]


def _fold_sql(c: str, kind) -> str:
    if isinstance(kind, tuple):
        return f"LEAST(COALESCE(SUM({c}), 0), {kind[1]})"
    return f"COALESCE(SUM({c}), 0)" if kind == "sum" else f"{kind.upper()}({c})"


_ACCT_COLS = ", ".join(_ACCT_EXPRS)


@query("reconcile_accounts", _with(
    f"a AS (SELECT {_ACCT_COLS}, {T.EVENT_ZONE_SQL} AS zone_id FROM events)",
    "dup AS (SELECT adventure_team_name FROM a WHERE adventure_team_name <> '' GROUP BY adventure_team_name "
    "HAVING count(adventure_team_name) > 1)",
    "r AS (SELECT guid, accid, CASE WHEN adventure_team_name IN (SELECT adventure_team_name FROM dup) "
    "AND adventure_team_name <> '' AND accid <> 0 AND zone_id <> 1 AND guid <> 0 "
    "THEN 's' || CAST(zone_id AS VARCHAR) || '.' || adventure_team_name ELSE adventure_team_name END "
    "AS adventure_team_name, adventure_team_level, adventure_team_exp, point, reg_time, " + ", ".join(_ACCT_FOLDS) + ", zone_id FROM a)",
    "s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accid ORDER BY CASE WHEN zone_id = 1 THEN 0 "
    "ELSE 1 END, adventure_team_level DESC, adventure_team_exp DESC, guid) AS rn FROM r) x WHERE rn = 1)",
    "g AS (SELECT accid, count(*) AS n, COALESCE(SUM(point), 0) AS sp, MIN(reg_time) AS mr, "
    + ", ".join(f"{_fold_sql(c, k)} AS f_{c}" for c, k in _ACCT_FOLDS.items()) + " FROM r GROUP BY accid)") + "SELECT "
    + ", ".join(f"CAST(CASE WHEN g.n > 1 THEN g.f_{c} ELSE s.{c} END AS BIGINT) AS {c}" for c in _ACCT_FOLDS) + """,
       s.guid, s.accid, s.adventure_team_name, s.adventure_team_level, s.adventure_team_exp,
       CAST(CASE WHEN g.n > 1 THEN g.sp ELSE s.point END AS BIGINT) AS point,
       CASE WHEN g.n > 1 THEN g.mr ELSE s.reg_time END AS reg_time
FROM s JOIN g ON g.accid = s.accid""")
def reconcile_accounts(spark, d):
    """R5 account/player/guild preset on three day-shards of accounts: append with lineage,
    duplicate team names renamed outside the main zone, accounts folded into one survivor."""
    from .reconcile import reconcile

    e = T.events_zoned(spark, d).selectExpr(*_ACCT_EXPRS, "zone")
    tenants = [Tenant(f"z{z}", z, {"t_account": e.where(F.col("zone") == z).drop("zone")}, {"t_account": "guid"})
               for z in (1, 2, 3)]
    return reconcile(tenants[0], tenants[1:]).main.table("t_account")


_GUILD_BITS = 1 << 54
#: an event as a player, as a guild (zone in the top bits of its id) and as the player's membership in it
_PLAYER_EXPRS = ["event_id AS guid", "user_id AS friend", "event_type || '-' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR(20)) AS name",
                 "'g' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR(20)) AS gname"]


@query("reconcile_players_guilds", _with(
    f"e AS (SELECT {', '.join(_PLAYER_EXPRS)}, {T.EVENT_ZONE_SQL} AS zone FROM events)",
    f"p AS (SELECT *, CAST(zone AS BIGINT) * {_GUILD_BITS} + guid AS gid, count(*) OVER (PARTITION BY name) AS n, count(*) OVER (PARTITION BY gname) AS gn FROM e)",
    "r AS (SELECT guid, 's' || CAST(zone AS VARCHAR) || '.' || name AS new_name FROM p WHERE name IS NOT NULL AND n > 1 AND zone <> 1 AND guid <> 0)",
    "gr AS (SELECT gid, guid, 's' || CAST(zone AS VARCHAR) || '.' || gname AS new_name FROM p WHERE gname IS NOT NULL AND gn > 1 AND zone <> 1)",
    "now AS (SELECT p.*, COALESCE(r.new_name, p.name) AS pname, COALESCE(gr.new_name, p.gname) AS gnow, COALESCE(o.new_name, 'o' || CAST(friend AS VARCHAR)) AS oname "
    "FROM p LEFT JOIN r ON r.guid = p.guid LEFT JOIN gr ON gr.gid = p.gid LEFT JOIN r o ON o.guid = p.guid + p.friend)") + """
SELECT 'player' AS kind, guid AS id, pname AS name, CAST(1 AS BIGINT) AS other FROM now
UNION ALL SELECT 'member', guid, pname, gid FROM now
UNION ALL SELECT 'rank', guid, pname || '/' || oname, guid + friend FROM now WHERE guid % 20 <> 17
UNION ALL SELECT 'rank', gid, gnow || '/' || pname, guid FROM now WHERE guid % 20 <> 17
UNION ALL SELECT 'guild', gid, gnow, CAST(0 AS BIGINT) FROM now
UNION ALL SELECT 'ledger', guid, new_name, CAST(1 AS BIGINT) FROM r
UNION ALL SELECT 'ledger', gr.guid, now.pname, CAST(2 AS BIGINT) FROM gr JOIN now ON now.gid = gr.gid WHERE gr.guid % 3 <> 0""")
def reconcile_players_guilds(spark, d):
    """R5 on three servers' players and guilds: duplicate names renamed outside the main zone, the copies in members and
    rankings with them, a ledger for players and for guild leaders, rankings of one type reset, and the final zone."""
    from .reconcile import reconcile

    e = T.events_zoned(spark, d).selectExpr(*_PLAYER_EXPRS, "zone").withColumn("gid", F.col("zone").cast("bigint") * _GUILD_BITS + F.col("guid"))
    post = F.when(F.col("guid") % 3 == 0, 1).otherwise(13).alias("post")  # some guilds have no leader
    rank = e.select(F.col("guid").alias("id"), "name", (F.col("guid") + F.col("friend")).alias("ownerid"), F.concat(F.lit("o"), F.col("friend").cast("string")).alias("ownername"), "zone")
    rank = rank.unionByName(e.select(F.col("gid").alias("id"), F.col("gname").alias("name"), F.col("guid").alias("ownerid"), F.col("name").alias("ownername"), "zone"))
    rank = rank.withColumn("sorttype", F.col("id") % _GUILD_BITS % 20)
    tables = {"t_player_info": e.select("guid", "name", F.col("zone").alias("zoneid"), "zone"), "t_guild_member": e.select("guid", "name", F.col("gid").alias("guildid"), post, "zone"),
              "t_sortlist": rank, "t_guild": e.select(F.col("gid").alias("guid"), F.col("gname").alias("name"), "zone")}
    keys = {"t_player_info": "guid", "t_guild_member": "guid", "t_sortlist": "id", "t_guild": "guid"}
    tenants = [Tenant(f"z{z}", z, {t: df.where(F.col("zone") == z).drop("zone") for t, df in tables.items()}, keys) for z in (1, 2, 3)]
    out = reconcile(tenants[0], tenants[1:]).main
    def rows(kind, table, key, name, other):
        return out.table(table).select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id"), name.alias("name"), other.cast("bigint").alias("other"))
    name = F.col("name")
    parts = [rows("member", "t_guild_member", "guid", name, F.col("guildid")), rows("rank", "t_sortlist", "id", F.concat("name", F.lit("/"), "ownername"), F.col("ownerid")),
             rows("guild", "t_guild", "guid", name, F.lit(0)), rows("ledger", "t_merge_give_namecard", "guid", name, F.col("type"))]
    first = rows("player", "t_player_info", "guid", name, F.col("zoneid"))
    for part in parts:
        first = first.unionByName(part)
    return first


_SIDE_EXPRS = ["event_id AS guid", "user_id AS accid", "CAST(day(ts) % 3 AS BIGINT) AS season", "CAST(floor(value / 100) AS BIGINT) AS level",
               "CAST(floor(value) AS BIGINT) AS points", "event_id % 7 AS dungeon_id"]


@query("reconcile_side_tables", _with(
    f"e AS (SELECT {', '.join(_SIDE_EXPRS)}, {T.EVENT_ZONE_SQL} AS zone FROM events)",
    "s AS (SELECT *, row_number() OVER (PARTITION BY accid ORDER BY CASE WHEN zone = 1 THEN 0 ELSE 1 END, season DESC, level DESC, points DESC, guid) AS adv, "
    "row_number() OVER (PARTITION BY accid ORDER BY CASE WHEN zone = 1 THEN 0 ELSE 1 END, season DESC, level DESC, guid) AS mono, "
    "count(*) OVER (PARTITION BY accid) AS n, SUM(points) OVER (PARTITION BY accid) AS coins, "
    "row_number() OVER (PARTITION BY accid, dungeon_id ORDER BY guid) AS dung, MAX(level) OVER (PARTITION BY accid, dungeon_id) AS hard FROM e)") + """
SELECT 'adventure' AS kind, accid, guid, points AS amount FROM s WHERE adv = 1
UNION ALL SELECT 'monopoly', accid, guid, CAST(CASE WHEN n > 1 THEN COALESCE(coins, 0) ELSE points END AS BIGINT) FROM s WHERE mono = 1
UNION ALL SELECT 'dungeon', accid, guid, hard FROM s WHERE dung = 1""")
def reconcile_side_tables(spark, d):
    """R5 on three servers' adventure, monopoly and dungeon rows: one row per account (and dungeon), coins summed,
    the hardest level kept."""
    from .reconcile import reconcile

    e = T.events_zoned(spark, d).selectExpr(*_SIDE_EXPRS, "zone")
    tables = {"t_account_adventure": e.select("guid", "accid", F.col("season").alias("seasonid"), "level", F.col("points").alias("exp"), "zone"),
              "t_account_monopoly": e.select("guid", "accid", F.col("season").alias("vsersion"), F.col("level").alias("roll_times"), F.col("points").alias("coin"), "zone"),
              "t_g_dungeon_hard": e.select("guid", F.col("accid").alias("account"), "dungeon_id", F.col("level").alias("unlocked_hard_type"), "zone")}
    tenants = [Tenant(f"z{z}", z, {t: df.where(F.col("zone") == z).drop("zone") for t, df in tables.items()}, dict.fromkeys(tables, "guid")) for z in (1, 2, 3)]
    out = reconcile(tenants[0], tenants[1:]).main
    parts = [("adventure", "t_account_adventure", "accid", "exp"), ("monopoly", "t_account_monopoly", "accid", "coin"), ("dungeon", "t_g_dungeon_hard", "account", "unlocked_hard_type")]
    rows = [out.table(t).select(F.lit(k).alias("kind"), F.col(a).alias("accid"), "guid", F.col(v).alias("amount")) for k, t, a, v in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _slice(spark, d) -> tuple[Tenant, Tenant, dict]:
    """Minimum slice: two tenants of customer/orders/lineitem remapped, renamed, stamped; and the shifted columns' offsets."""
    main = T.main_tenant(spark, d, ("customer", "orders", "lineitem"))
    sub = T.sub_tenant(spark, d, ("customer", "orders", "lineitem"))
    groups = [[("customer", "c_custkey"), ("orders", "o_custkey")], [("orders", "o_orderkey"), ("lineitem", "l_orderkey")]]
    offs = K.max_ids([main, sub], [g[0] for g in groups])
    for g in groups:
        sub = K.shift_group(sub, g, offs[g[0]])
    sub = sub.replace(customer=N.affix_conflicts(sub.table("customer"), main.table("customer"), "c_name", "s2.", "prefix"))
    main = main.replace(orders=P.with_zone(main.table("orders"), 1))
    sub = sub.replace(orders=P.with_zone(sub.table("orders"), 2))
    return main, sub, {c: offs[g[0]] for g in groups for c in g}


_SLICE = (T.CM, T.CS, T.OM, T.OS, T.lines_of_sql("lm", "om"), T.lines_of_sql("ls", "os"),
          f"css AS (SELECT {_shift_sql('c_custkey', _COFF)} AS c_custkey, CASE WHEN c_name IN (SELECT c_name FROM cm) "
          f"THEN 's2.' || c_name ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM cs)",
          f"oss AS (SELECT {_shift_sql('o_orderkey', _OOFF)} AS o_orderkey, {_shift_sql('o_custkey', _COFF)} AS o_custkey, "
          f"o_totalprice, 2 AS zone_id FROM os)",
          f"lss AS (SELECT {_shift_sql('l_orderkey', _OOFF)} AS l_orderkey, l_extendedprice, l_discount FROM ls)",
          "cu AS (SELECT c_custkey, c_mktsegment FROM cm WHERE NOT EXISTS (SELECT 1 FROM css WHERE css.c_custkey = cm.c_custkey) "
          "UNION ALL SELECT c_custkey, c_mktsegment FROM css)",
          "ou AS (SELECT o_orderkey, o_custkey, 1 AS zone_id FROM om WHERE NOT EXISTS (SELECT 1 FROM oss WHERE oss.o_orderkey = om.o_orderkey) "
          "UNION ALL SELECT o_orderkey, o_custkey, zone_id FROM oss)",
          "lu AS (SELECT l_orderkey, l_extendedprice, l_discount FROM lm UNION ALL SELECT * FROM lss)")

ZONE_REVENUE_SQL = _with(*_SLICE) + """
SELECT ou.zone_id, cu.c_mktsegment,
       CAST(SUM(CAST(lu.l_extendedprice * (1 - lu.l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
       CAST(count(*) AS BIGINT) AS n_lines
FROM lu JOIN ou ON ou.o_orderkey = lu.l_orderkey JOIN cu ON cu.c_custkey = ou.o_custkey
GROUP BY ou.zone_id, cu.c_mktsegment"""


@query("zone_revenue", ZONE_REVENUE_SQL)
def zone_revenue(spark, d):
    """Flagship: remap two tenants (K1-K3), rename conflicting names (N2), stamp
    lineage (P5), merge (M1/M6), then revenue per zone and segment."""
    main, sub, shifted = _slice(spark, d)
    merged, _ = M.merge_tenant(main, sub, shifted=shifted)
    li = merged.table("lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    o = merged.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "zone_id")
    c = merged.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rev = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    return li.join(o, "l_orderkey").join(c, "o_custkey").groupBy("zone_id", "c_mktsegment") \
        .agg(F.sum(rev).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))


# ---------------------------------------------------------------- rule sets
RULES_TYPE1 = {
    "type": "1",
    "other_identity": [{"db_table": "orders", "db_field": "o_orderkey"}, {"db_table": "customer", "db_field": "c_custkey"}],
    "un_merge": [],
    "prefix_setting": {"role_is": "1", "guild_is": "0", "repeat_modify": "2", "additional_string": "2",
                       "prefix": "_s2", "account_change": "0",
                       "role_name": [{"db_table": "customer", "db_field": "c_name", "not_equal": ""}]},
    "server_info": {"server_is": "1", "server_sql": [{"db_table": "customer", "db_field": "c_nationkey"}]},
}


@query("rule_type1", _with(T.CM, T.CS) + f"""
SELECT * FROM cm WHERE NOT EXISTS (SELECT 1 FROM cs WHERE {_shift_sql('cs.c_custkey', _COFF)} = cm.c_custkey)
UNION ALL
SELECT {_shift_sql('c_custkey', _COFF)}, CASE WHEN c_name <> '' THEN c_name || '_s2' ELSE c_name END,
       CAST(99 AS INTEGER), c_acctbal, c_mktsegment FROM cs""")
def rule_type1(spark, d):
    """K10/R1 type 1: independent ids, name suffix, server stamp, merge."""
    res = J.run_rules(T.main_tenant(spark, d), [J.SubTenant(T.sub_tenant(spark, d), server_id=99)], RULES_TYPE1)
    return res.main.table("customer")


def _three_subs_sql() -> str:
    shifted = lambda k: (f"o{k} AS (SELECT CASE WHEN o_orderkey > 0 THEN o_orderkey + (SELECT v FROM m{k}) ELSE o_orderkey END AS o_orderkey, "  # noqa: E731
                         f"o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, {k} AS src FROM s{k})")
    ctes = [T.OM.replace("om AS", "o0 AS", 1).replace("SELECT", "SELECT 0 AS src,", 1), T.OS.replace("os AS", "s1 AS", 1), T.OT.replace("ot AS", "s2 AS", 1),
            T.OS.replace("os AS", "s3 AS", 1)]
    for k in (1, 2, 3):
        before = [f"o{j}" for j in range(k)]
        ctes += [f"m{k} AS (SELECT {_max_sql('o_orderkey', *before, f's{k}')} AS v)", shifted(k)]
    both = " UNION ALL ".join(f"SELECT {OCOLS}, src FROM o{k}" for k in range(4))
    # ids that aren't positive aren't shifted, so they meet: the last source keeps them
    return _with(*ctes) + f"SELECT {OCOLS} FROM ({both}) u QUALIFY src = max(src) OVER (PARTITION BY o_orderkey) OR o_orderkey IS NULL"


@query("rule_three_subs", _three_subs_sql())
def rule_three_subs(spark, d):
    """R1 over three subs: each is shifted past what main holds by then, all are merged in one pass."""
    rules = {"type": "1", "other_identity": [{"db_table": "orders", "db_field": "o_orderkey"}]}
    subs = [Tenant(f"sub{k}", k + 1, {"orders": df}, T.SPECS) for k, df in enumerate((T.os_(spark, d), T.ot(spark, d), T.os_(spark, d)), 1)]
    return J.run_rules(T.main_tenant(spark, d, ("orders",)), [J.SubTenant(t) for t in subs], rules).main.table("orders")


@query("rule_type3_wide", _with(T.OM, T.OS) + """
SELECT CAST(1500000000 AS BIGINT) + o_custkey AS o_custkey, o_orderkey FROM om
UNION ALL SELECT CAST(1400000000 AS BIGINT) + o_custkey
  + GREATEST((SELECT max(o_custkey) FROM om) + 1500000000, (SELECT max(o_custkey) FROM os) + 1400000000), o_orderkey FROM os""")
def rule_type3_wide(spark, d):
    """K10 type 3: int ids near the type's limit are widened before they are shifted."""
    def tenant(name, zone, orders, base):
        ids = orders.select((F.col("o_custkey") + base).cast("int").alias("o_custkey"), "o_orderkey")
        return Tenant(name, zone, {"orders": ids})
    rules = {"type": "3", "simple_process": {"character_types": "1", "deal_with": [{"db_table": "orders", "db_field": "o_custkey", "associated": ""}]}}
    main, sub = tenant("main", 1, T.om(spark, d), 1500000000), tenant("sub", 2, T.os_(spark, d), 1400000000)
    return J.run_rules(main, [J.SubTenant(sub)], rules).main.table("orders")


@query("write_reopen", _with(T.OM, T.OS) + f"""
SELECT {OCOLS} FROM om WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = om.o_orderkey)
UNION ALL SELECT {OCOLS} FROM os""")
def write_reopen(spark, d):
    """A merged tenant is written, its published version found and opened again, and scanned."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources.sinks import read_published, write_tenant

    merged, _ = M.merge_tenant(T.main_tenant(spark, d, ("orders",)), T.sub_tenant(spark, d, ("orders",)))
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tenant-{uuid.uuid4().hex}"
    write_tenant(merged, out, "1")
    return read_published(spark, out, "1", "main", 1, ["orders"]).table("orders").select(*ORDER_COLS)


RULES_TYPE2 = {
    "type": "2",
    "restructure_state": "1",
    "restructure_tool": [{"group": [{"db_table": "customer", "db_field": "c_custkey", "conditions": ""},
                                    {"db_table": "orders", "db_field": "o_custkey", "conditions": ""}]}],
    "same": [{"group": [{"db_table": "customer", "db_field": "c_custkey"}, {"db_table": "orders", "db_field": "o_custkey"}]}],
    "other_identity": [{"db_table": "orders", "db_field": "o_orderkey"}],
    "special_option": {"special_field_open": "1", "teshudb_field_open": "0",
                       "special_field": [{"db_table": "orders", "db_field": "o_orderkey", "group": "1", "type": "1",
                                          "conditions": "where o_orderpriority = '1-URGENT'"}]},
    "un_merge": [],
    "prefix_setting": {"role_is": "1", "repeat_modify": "1", "additional_string": "1", "prefix": "s2.",
                       "role_name": [{"db_table": "customer", "db_field": "c_name", "not_equal": ""}]},
}


def _rule2_sql() -> str:
    ren = ("{n} AS (SELECT c_custkey AS old, CAST(dense_rank() OVER (ORDER BY c_custkey) AS BIGINT) AS nid FROM {src})")
    ctes = [T.CM, T.CS, T.OM, T.OS, ren.format(n="mm", src="cm"), ren.format(n="ms", src="cs"),
            "cm2 AS (SELECT COALESCE(mm.nid, cm.c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
            "FROM cm LEFT JOIN mm ON mm.old = cm.c_custkey)",
            "om2 AS (SELECT o_orderkey, COALESCE(mm.nid, om.o_custkey) AS o_custkey, o_orderstatus, o_totalprice, "
            "o_orderdate, o_orderpriority FROM om LEFT JOIN mm ON mm.old = om.o_custkey)",
            "cs2 AS (SELECT COALESCE(ms.nid, cs.c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
            "FROM cs LEFT JOIN ms ON ms.old = cs.c_custkey)",
            "os2 AS (SELECT o_orderkey, COALESCE(ms.nid, os.o_custkey) AS o_custkey, o_orderstatus, o_totalprice, "
            "o_orderdate, o_orderpriority FROM os LEFT JOIN ms ON ms.old = os.o_custkey)",
            f"g AS (SELECT {_max_sql('c_custkey', 'cm2', 'cs2')} AS v)",
            f"x AS (SELECT {_max_sql('o_orderkey', 'om2', 'os2')} AS v)",
            "cs3 AS (SELECT CASE WHEN c_custkey > 0 THEN c_custkey + (SELECT v FROM g) ELSE c_custkey END AS c_custkey, "
            "CASE WHEN c_name IN (SELECT c_name FROM cm2) AND c_name <> '' THEN 's2.' || c_name ELSE c_name END AS c_name, "
            "c_nationkey, c_acctbal, c_mktsegment FROM cs2)",
            "os3 AS (SELECT CASE WHEN o_orderkey > 0 THEN o_orderkey + (SELECT v FROM x) ELSE o_orderkey END "
            "+ CASE WHEN o_orderpriority = '1-URGENT' THEN (SELECT v FROM g) ELSE 0 END AS o_orderkey, "
            "CASE WHEN o_custkey > 0 THEN o_custkey + (SELECT v FROM g) ELSE o_custkey END AS o_custkey, "
            "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM os2)",
            "cu AS (SELECT * FROM cm2 WHERE NOT EXISTS (SELECT 1 FROM cs3 WHERE cs3.c_custkey = cm2.c_custkey) "
            "UNION ALL SELECT * FROM cs3)",
            "ou AS (SELECT * FROM om2 WHERE NOT EXISTS (SELECT 1 FROM os3 WHERE os3.o_orderkey = om2.o_orderkey) "
            "UNION ALL SELECT * FROM os3)"]
    return _with(*ctes) + """
SELECT ou.o_orderkey, ou.o_custkey, cu.c_name, ou.o_totalprice FROM ou LEFT JOIN cu ON cu.c_custkey = ou.o_custkey"""


RULES_RENUMBER = {
    "type": "2", "restructure_state": "1",
    "restructure_tool": [{"group": [{"db_table": "customer", "db_field": "c_custkey"}, {"db_table": "orders", "db_field": "o_custkey"}]}],
    "same": [{"group": [{"db_table": "customer", "db_field": "c_custkey"}, {"db_table": "orders", "db_field": "o_custkey"}]}],
    "other_identity": [{"db_table": "orders", "db_field": "o_orderkey"}],
}
_RENUMBER_SEGMENTS = (("BUILDING",), T.SEG_SUB, T.SEG_THIRD, T.SEG_MAIN)
_RENUMBER_STATUS = (T.STATUS_MAIN, T.STATUS_SUB, T.STATUS_THIRD, T.STATUS_SUB)


def _renumber_three_sql() -> str:
    """The subs one by one: main and sub renumbered, the sub shifted past both, merged."""
    ren = lambda n, src: f"{n} AS MATERIALIZED (SELECT c_custkey AS old, dense_rank() OVER (ORDER BY c_custkey) AS nid FROM {src})"
    c_cols, o_cols = "c_name, c_nationkey, c_acctbal, c_mktsegment", "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
    ctes = []
    for k in range(4):
        ctes += [T.customer_cut_sql(f"c{k}", _RENUMBER_SEGMENTS[k], float(k)), T.orders_cut_sql(f"o{k}", _RENUMBER_STATUS[k], float(k))]
    mc, mo = "c0", "o0"
    for k in (1, 2, 3):
        mapped = lambda t, m: (f"SELECT COALESCE(nid, c_custkey) AS c_custkey, {c_cols} FROM {t} LEFT JOIN {m} ON old = c_custkey")
        mapped_o = lambda t, m: (f"SELECT o_orderkey, COALESCE(nid, o_custkey) AS o_custkey, {o_cols} FROM {t} LEFT JOIN {m} ON old = o_custkey")
        ctes += [ren(f"rm{k}", mc), ren(f"rs{k}", f"c{k}"), f"mc{k} AS ({mapped(mc, f'rm{k}')})", f"sc{k} AS ({mapped(f'c{k}', f'rs{k}')})",
                 f"mo{k} AS ({mapped_o(mo, f'rm{k}')})", f"so{k} AS ({mapped_o(f'o{k}', f'rs{k}')})",
                 f"g{k} AS (SELECT {_max_sql('c_custkey', f'mc{k}', f'sc{k}')} AS v)", f"x{k} AS (SELECT {_max_sql('o_orderkey', f'mo{k}', f'so{k}')} AS v)",
                 f"tc{k} AS (SELECT {_shift_sql('c_custkey', f'(SELECT v FROM g{k})')} AS c_custkey, {c_cols} FROM sc{k})",
                 f"to{k} AS (SELECT {_shift_sql('o_orderkey', f'(SELECT v FROM x{k})')} AS o_orderkey, {_shift_sql('o_custkey', f'(SELECT v FROM g{k})')} AS o_custkey, {o_cols} FROM so{k})",
                 f"nc{k} AS MATERIALIZED (SELECT * FROM mc{k} WHERE c_custkey NOT IN (SELECT c_custkey FROM tc{k}) UNION ALL SELECT * FROM tc{k})",
                 f"no{k} AS MATERIALIZED (SELECT * FROM mo{k} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM to{k}) UNION ALL SELECT * FROM to{k})"]
        mc, mo = f"nc{k}", f"no{k}"
    return _with(*ctes) + f"SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, c_name, o_totalprice FROM {mo} LEFT JOIN {mc} ON c_custkey = o_custkey"


@query("rule_renumber_three_subs", _renumber_three_sql())
def rule_renumber_three_subs(spark, d):
    """K5 in R1 over three subs: main's renumberings are composed, each table is rewritten once."""
    ten = [Tenant(f"t{k}", k + 1, {"customer": T.customer_cut(spark, d, _RENUMBER_SEGMENTS[k], float(k)), "orders": T.orders_cut(spark, d, _RENUMBER_STATUS[k], float(k))}, T.SPECS)
           for k in range(4)]
    out = J.run_rules(ten[0], [J.SubTenant(t) for t in ten[1:]], RULES_RENUMBER).main
    c = out.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return out.table("orders").join(c, "o_custkey", "left").select("o_orderkey", F.col("o_custkey").cast("long"), "c_name", "o_totalprice")


RULES_TEXT_IDS = {
    "type": "2", "restructure_state": "1",
    "restructure_tool": [{"group": [{"db_table": "part", "db_field": "p_partkey"}]}],
    "same": [{"group": [{"db_table": "part", "db_field": "p_partkey"}]}],
    "other_identity": [{"db_table": "basket", "db_field": "b_id"}],
    "special_option": {"teshudb_field_open": "1", "teshudb_field": [
        {"db_table": "basket", "db_field": "b_parts", "db_table_attribution": "part", "db_field_attribution": "p_partkey", "group": "1", "type": "1", "delimiter": ","}]},
}


def _text_tenant(spark, d, name, zone, statuses, lo, hi):
    """Parts by size, and each order's parts as a text of ids."""
    lines = T.lines_of(spark, d, T.orders_cut(spark, d, statuses))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"].cast("string")), ",")
    return Tenant(name, zone, {"part": T.part_cut(spark, d, lo, hi), "basket": lines.groupBy(F.col("l_orderkey").alias("b_id")).agg(parts.alias("b_parts"))},
                  {"part": "p_partkey", "basket": "b_id"})


def _text_ids_sql() -> str:
    ctes = [T.orders_cut_sql("om", T.STATUS_MAIN), T.orders_cut_sql("os", T.STATUS_SUB), T.part_cut_sql("pm", hi=30), T.part_cut_sql("ps", lo=20)]
    for t in "ms":
        ctes.append(f"r{t} AS (SELECT p_partkey AS old, dense_rank() OVER (ORDER BY p_partkey) AS nid FROM p{t})")
    ctes.append("v AS (SELECT greatest((SELECT max(nid) FROM rm), (SELECT max(nid) FROM rs)) AS off, "
                "greatest((SELECT max(o_orderkey) FROM om WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), "
                "(SELECT max(o_orderkey) FROM os WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))) AS base)")
    basket = lambda t, key, new: (f"SELECT {key} AS b_id, string_agg(COALESCE({new}, l_partkey)::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS b_parts "  # noqa: E731
                                  f"FROM lineitem JOIN o{t} ON o_orderkey = l_orderkey LEFT JOIN r{t} ON old = l_partkey CROSS JOIN v GROUP BY {key}")
    shifted = "CASE WHEN l_orderkey > 0 THEN l_orderkey + base ELSE l_orderkey END"
    # a token that names no part of the sub isn't renumbered; it is shifted if it happens to be a renumbered part's id
    moved = "COALESCE(nid + off, CASE WHEN l_partkey BETWEEN 1 AND (SELECT max(nid) FROM rs) THEN l_partkey + off END)"
    ctes += [f"bm AS ({basket('m', 'l_orderkey', 'nid')})", f"bs AS ({basket('s', shifted, moved)})"]
    return _with(*ctes) + "SELECT b_id, b_parts FROM bm WHERE b_id NOT IN (SELECT b_id FROM bs) UNION ALL SELECT b_id, b_parts FROM bs"


@query("rule_text_ids", _text_ids_sql())
def rule_text_ids(spark, d):
    """K5 + K7: ids inside a text follow the renumbering of the rows that they name, then the shift."""
    main, sub = _text_tenant(spark, d, "main", 1, T.STATUS_MAIN, None, 30), _text_tenant(spark, d, "sub", 2, T.STATUS_SUB, 20, None)
    return J.run_rules(main, [J.SubTenant(sub)], RULES_TEXT_IDS).main.table("basket")


@query("rule_type2", _rule2_sql())
def rule_type2(spark, d):
    """K10/R1 type 2: dense renumber, group shift, independent shift,
    polymorphic shift, conflict-only prefix, merge."""
    res = J.run_rules(T.main_tenant(spark, d), [J.SubTenant(T.sub_tenant(spark, d))], RULES_TYPE2)
    o, c = res.main.table("orders"), res.main.table("customer")
    return o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left") \
        .select("o_orderkey", "o_custkey", "c_name", "o_totalprice")


RULES_TYPE3 = {
    "type": "3",
    "simple_process": {"character_types": "1",
                       "deal_with": [{"db_table": "customer", "db_field": "c_custkey", "associated": "o_custkey"}],
                       "primary_key": [{"db_field": "o_orderkey"}, {"db_field": "c_custkey"}]},
    "un_merge": [],
}


@query("rule_type3", _with(T.CM, T.CS, T.OM, T.OS,
                           f"cs3 AS (SELECT {_shift_sql('c_custkey', _COFF)} AS c_custkey, c_name FROM cs)",
                           f"os3 AS (SELECT {_shift_sql('o_orderkey', _OOFF)} AS o_orderkey, "
                           f"{_shift_sql('o_custkey', _COFF)} AS o_custkey, o_totalprice FROM os)",
                           "cu AS (SELECT c_custkey, c_name FROM cm WHERE NOT EXISTS (SELECT 1 FROM cs3 WHERE cs3.c_custkey = cm.c_custkey) "
                           "UNION ALL SELECT * FROM cs3)",
                           "ou AS (SELECT o_orderkey, o_custkey, o_totalprice FROM om WHERE NOT EXISTS "
                           "(SELECT 1 FROM os3 WHERE os3.o_orderkey = om.o_orderkey) UNION ALL SELECT * FROM os3)") + """
SELECT ou.o_orderkey, ou.o_custkey, cu.c_name, ou.o_totalprice FROM ou LEFT JOIN cu ON cu.c_custkey = ou.o_custkey""")
def rule_type3(spark, d):
    """K10/R1 type 3: associated columns, then primary-key names (each column once, H4)."""
    res = J.run_rules(T.main_tenant(spark, d), [J.SubTenant(T.sub_tenant(spark, d))], RULES_TYPE3)
    o, c = res.main.table("orders"), res.main.table("customer")
    return o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left") \
        .select("o_orderkey", "o_custkey", "c_name", "o_totalprice")
