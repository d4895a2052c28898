"""Retention and post-merge resets (I14-I18): inactive-entity purge with cascade,
the declarative purge spec, reset rules and the final zone stamp.

A purge is a filter giving the purged ids, which are written once with
their count and read by every child: as a broadcast where the count allows
it (a child is then streamed without a shuffle, whatever its number of id
columns), else by a join that splits frequent ids.  No id ever reaches the
driver and there is no 5,000-id ``IN`` batching.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_true
from ..model import Tenant
from ..session import cut_lineage
from .lookup import lookup
from .rows import apply_rules, delete_where


#: fixed values: the inactive-player purge thresholds
INACTIVE_DAYS = 30
INACTIVE_MAX_LEVEL = 30
INACTIVE_MAX_ONLINE_SECONDS = 24 * 3600


#: purged ids up to this many bytes are broadcast to the children's scans
BROADCAST_BYTES = 8 << 20


def purge_set(ids: DataFrame) -> tuple[DataFrame, bool]:
    """Distinct non-null ids of a one-column frame, written once, and whether they may be broadcast."""
    c = ids.columns[0]
    written = cut_lineage(ids.select(F.col(c).alias("__pid")).where(F.col("__pid").isNotNull()).distinct())
    width = F.octet_length(F.col("__pid").cast("string")) + 8
    size = written.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return written, int(size) <= BROADCAST_BYTES


def purge_children(df: DataFrame, cols: Sequence[str], purged: DataFrame, small: bool = False) -> DataFrame:
    """Drop rows whose value in **any** of ``cols`` is a purged id; NULLs are never purged.

    ``small``: ``purged`` is the written result of :func:`purge_set` and may
    be broadcast, so all columns are checked in one pass over ``df``.
    """
    ids = purged.select(F.col(purged.columns[0]).alias("__pid"))
    present = [c for c in cols if c in df.columns]
    if small:
        for c in present:
            df = df.join(F.broadcast(ids), df[c] == ids["__pid"], "left_anti")
        return df
    ids = ids.distinct()
    for k, c in enumerate(present):
        df = lookup(df, c, ids, "__pid", {f"__p{k}": "__pid"}).where(F.col(f"__p{k}").isNull()).drop(f"__p{k}")
    return df


def purge(tenant: Tenant, table: str, id_col: str, predicate, cascade: Mapping[str, Sequence[str] | str]) -> Tenant:
    """Delete the entities of ``table`` matching ``predicate`` and cascade.

    ``cascade``: child table -> column(s) holding the entity id.  The purged
    ids are worked out once for all children; the entity table itself is
    filtered by the predicate (``delete_where``).
    """
    ent = tenant.table(table)
    out = {table: delete_where(ent, predicate)}
    children = {t: [cols] if isinstance(cols, str) else list(cols) for t, cols in cascade.items() if t != table and tenant.has(t)}
    if children:
        purged, small = purge_set(ent.where(is_true(predicate)).select(id_col))
        out |= {t: purge_children(tenant.table(t), cols, purged, small) for t, cols in children.items()}
    return tenant.with_tables(out)


def inactive_player(as_of: datetime | int, deletetime: str = "deletetime", savetime_ms: str = "savetime",
                    level: str = "level", online_s: str = "totleonlinetime", paid: str = "totlechargenum") -> Column:
    """The purge predicate of the append-and-reconcile job (epoch columns).

    Not deleted, last save more than 30 days before ``as_of``, level below 30,
    under 24 h online, never paid.  ``as_of`` is explicit (epoch seconds or a
    datetime): never the wall clock, so reruns give the same answer.
    """
    now = _epoch(as_of) if isinstance(as_of, datetime) else int(as_of)
    return ((F.col(deletetime) == 0)
            & (F.col(savetime_ms) / 1000 + INACTIVE_DAYS * 24 * 3600 < F.lit(now))
            & (F.col(level) < INACTIVE_MAX_LEVEL)
            & (F.col(online_s) < INACTIVE_MAX_ONLINE_SECONDS)
            & (F.col(paid) == 0))


def _epoch(t: datetime) -> int:
    """Epoch seconds of ``t``; a naive datetime is read as UTC (never the machine's zone)."""
    return int((t if t.tzinfo else t.replace(tzinfo=timezone.utc)).timestamp())


def _older_than(c: str, days: int, as_of: datetime, time_format: str) -> Column:
    """``time_format`` 1 = timestamp column (wall time), 2 = epoch seconds."""
    if str(time_format) == "2":
        return F.col(c) < F.lit(_epoch(as_of - timedelta(days=int(days))))
    limit = F.lit((as_of - timedelta(days=int(days))).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.col(c).cast("timestamp_ntz") < limit


def purge_from_spec(tenant: Tenant, spec: Mapping, as_of: datetime) -> Tenant:
    """I16 ``cleaning_tools``: purge entities that are low level **and** inactive.

    ``conditions``: a type-1 entry (``table.field < level``) and a type-2 entry
    (``table.field`` older than ``day`` days before ``as_of``), joined on their
    ``common`` key; the ids are removed from every ``cleaning_table`` (table,
    column) and the condition tables.  ``all_clear`` entries delete rows with
    ``field <conditions>`` (e.g. ``backpack <0``) whatever the purge.  Off
    unless ``state == "1"`` (the reference never runs it, H8).
    """
    if str(spec.get("state", "0")) != "1":
        return tenant
    conds = spec.get("conditions") or []
    level = int(spec.get("level", 0))
    days = int(spec.get("day", 0))
    sets = []
    for cnd in conds:
        t, f, common = cnd["db_table"], cnd["db_field"], cnd["common"]
        if not tenant.has(t):
            continue
        df = tenant.table(t)
        if str(cnd.get("type")) == "1":
            pred = F.col(f) < F.lit(level)
        else:
            pred = _older_than(f, days, as_of, cnd.get("time_format", "1"))
        sets.append(df.where(pred).select(F.col(common).alias("__id")).distinct())
    out = tenant
    if sets:
        purged = sets[0]
        for s in sets[1:]:
            purged = purged.join(s, "__id", "inner")
        cascade: dict[str, list[str]] = {}
        for item in spec.get("cleaning_table") or []:
            cascade.setdefault(item["db_table"], []).append(item["db_field"])
        for cnd in conds:
            cascade.setdefault(cnd["db_table"], []).append(cnd["common"])
        purged, small = purge_set(purged)
        out = out.with_tables({t: purge_children(out.table(t), sorted(set(cs), key=cs.index), purged, small)
                               for t, cs in cascade.items() if out.has(t)})
    for item in spec.get("all_clear") or []:
        t = item["db_table"]
        if out.has(t):
            out = out.with_tables({t: delete_where(out.table(t), f"{item['db_field']} {item['conditions']}")})
    return out


def reset(tenant: Tenant, rules: Mapping[str, Sequence[tuple]]) -> Tenant:
    """I17 post-merge resets: per table an ordered list of

    * ``("set", column, value, predicate_or_None)`` (P1/P2); ``value`` is a
      literal, or a Column for computed values,
    * ``("delete", predicate)`` (P8).
    """
    out = {}
    for t, steps in rules.items():
        if not tenant.has(t):
            continue
        df = tenant.table(t)
        for step in steps:
            if step[0] == "set":
                _, c, v, pred = step
                v = v if isinstance(v, Column) else F.lit(v)
                df = apply_rules(df, [(c, v, pred)]) if c in df.columns else df
            elif step[0] == "delete":
                df = delete_where(df, step[1])
            else:
                raise ValueError(f"unknown reset step {step[0]!r}")
        out[t] = df
    return tenant.with_tables(out)


#: fixed values: post-merge resets of the append-and-reconcile job, table by table
APPEND_RECONCILE_RESETS = {
    "t_auction_new": [("set", "duetime", 0, None)],
    "t_counter": [
        ("set", "value", 10, "name = 'jar_buy_dis_remain_501'"),
        ("set", "value", 50, "name IN ('jar_buy_dis_remain_601', 'jar_buy_dis_remain_602', 'jar_buy_dis_remain_603', "
                             "'jar_buy_dis_remain_604', 'jar_buy_dis_remain_605', 'jar_buy_dis_remain_606', "
                             "'jar_buy_dis_remain_607')"),
        ("set", "value", 0, "name = 'buy_mall_fashion_num'"),
    ],
    "t_blackmarket_auction": [("set", "off_sale", 1, "is_settled = 0")],
    "t_blackmarket_transaction": [("set", "off_sale", 1, "state = 0")],
    "t_sortlist": [("delete", "sorttype = 17")],
    "t_guild": [("set", "enroll_terrid", 0, None), ("set", "battle_score", 0, None),
                ("set", "occupy_terrid", 0, None), ("set", "inspire", 0, None)],
    "t_figure_statue": [("delete", "statuetype IN (1, 2, 3)")],
    "t_account": [("set", "adventure_team_grade_id", 0, None), ("set", "all_role_value_score", 0, None),
                  ("set", "unlocked_new_occus", "", None), ("set", "query_new_occus_time", 0, None)],
    "t_player_info": [("set", "add_preferences_time", 0, None), ("set", "del_preferences_time", 0, None)],
}


def final_zone(df: DataFrame, zone_cols: Iterable[str], main_zone: int, drop: Iterable[str] = ("zone_id",)) -> DataFrame:
    """Every row to the main zone, lineage column(s) dropped."""
    df = df.withColumns({c: F.lit(main_zone).cast(df.schema[c].dataType) for c in zone_cols if c in df.columns})
    return df.drop(*[c for c in drop if c in df.columns])
