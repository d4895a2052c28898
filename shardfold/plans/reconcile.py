"""The append-and-reconcile job for the account/player/guild game schema.

:func:`reconcile` appends every sub (:func:`shardfold.plans.jobs.append_reconcile`'s
append step) and then runs the reconciliation steps in the order the
reference runs them: player renames, team renames, team-data survivors,
adventure survivors, hire reconciliation, monopoly fold, account fold,
dungeon fold, guild renames, resets, final zone.  Each step is one of the
operators; table and column names are the schema's fixed names.  Steps
whose tables are absent are skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Tenant
from ..operators import identity as I
from ..operators import merge as M
from ..operators import names as N
from ..operators import retention as R
from ..session import cut_lineage
from .jobs import APPEND_RECONCILE_TABLES, JobResult, _append_table

ZONE = "zone_id"

#: fixed values: account fold, column -> how duplicates fold into the surviving account
ACCOUNT_FOLDS = {
    "point": "sum", "credit_point": "sum", "reg_time": "min", "vipexp": "max", "viplvl": "max",
    "total_charge_num": "sum", "storage_size": "max", "role_delete_time": "max", "role_recover_time": "max",
    "money_manage_status": "max", "gnome_coin_num": "sum", "gnome_coin_refresh_time": "max",
    "weapon_lease_tickets": ("sum_capped", 200), "unlock_extensible_role_num": "sum", "offline_time": "max",
    "mall_point": "sum", "adventure_coin": "sum",
}

#: fixed values: tables whose acc_guid must name a kept team account (and the row filter)
TEAM_DATA_CHILDREN = {
    "t_account_counter": "counter_type IN (1, 2, 3, 4, 6)",
    "t_account_shop_acc_buy_record": None,
    "t_expedition_map": None,
    "t_expedition_member": None,
    "t_account_task": None,
}

#: fixed values: account foreign keys re-pointed to the surviving account, (table, set column, match column)
ACCOUNT_REPOINTS = (
    ("t_account_counter", "acc_guid", "owner"),
    ("t_account_shop_acc_buy_record", "acc_guid", "owner"),
    ("t_expedition_map", "acc_guid", "accid"),
    ("t_expedition_member", "acc_guid", "accid"),
)

#: fixed values: player-name copies updated by a player rename, (table, match column, name column)
PLAYER_NAME_COPIES = (
    ("t_guild_member", "guid", "name"),
    ("t_relation", "id", "name"),
    ("t_sortlist", "id", "name"),
    ("t_sortlist", "ownerid", "ownername"),
)

#: fixed values: inactive-player purge cascade, table -> player-id column(s) (opt-in, H8)
INACTIVE_PLAYER_CASCADE = {
    "t_active_task": "owner", "t_activity_op_task": "guid", "t_activity_op_task_new": "owner_id",
    "t_counter": "owner", "t_dungeon": "owner", "t_guild_member": "guid", "t_item": "owner",
    "t_jaritem_pool": "owner", "t_mail": "owner", "t_mailitem": "owner", "t_offline_event": "owner",
    "t_pk_statistic": "owner", "t_red_packet": "owner_id", "t_red_packet_receiver": "receiver_id",
    "t_retinue": "owner", "t_shop": "owner", "t_shopitem": "owner", "t_task": "owner", "t_pet": "owner",
    "t_mall_gift_pack": "roleid", "t_questionnaire": "owner", "t_account_shop_role_buy_record": "owner",
    "t_activity_op_attribute": "owner", "t_mall_item": "roleid", "t_new_title": "roleid",
    "t_relation": ["owner", "id"], "t_sortlist": ["ownerid", "id"], "t_mastersect_relation": ["owner", "id"],
}

#: fixed values: tables that carry the temporary lineage zone
ZONED_TABLES = ("t_account", "t_account_adventure", "t_account_monopoly")


def _ledger(df: DataFrame, guid=None, accid=None) -> DataFrame:
    return df.select(F.col(guid).cast("bigint").alias("guid") if guid else F.lit(None).cast("bigint").alias("guid"),
                     F.col(accid).cast("bigint").alias("accid") if accid else F.lit(None).cast("bigint").alias("accid"),
                     "name", F.col("type").cast("int").alias("type"))


def _present(res: JobResult, table: str, df: DataFrame, cols: Mapping) -> dict:
    """The declared columns that are there; a missing one is reported."""
    res.actions.extend((res.main.name, table, f"no column {c}") for c in cols if c not in df.columns)
    return {c: v for c, v in cols.items() if c in df.columns}


def reconcile(main: Tenant, subs: Sequence[Tenant], zid: int | None = None, append: Mapping | None = None,
              purge_as_of: datetime | None = None) -> JobResult:
    """Append all subs into main and reconcile players, accounts and guilds.

    ``zid``: the zone the merged server becomes (default main's zone).
    ``append``: per-table append modes (default :data:`APPEND_RECONCILE_TABLES`);
    tables outside it stay as main has them.  ``purge_as_of``: run the
    inactive-player purge (off by default, as in the reference).  The
    compensation ledger is added to main's ``t_merge_give_namecard``.  Each
    row keeps the zone of the tenant it came from, whatever the number of
    subs.  ``actions`` tells of every sub table: ``appended``, ``emptied``,
    ``missing`` (main lacks it) or ``not listed``; and of declared columns
    that are not there.
    """
    zid = main.zone if zid is None else zid
    modes = dict(APPEND_RECONCILE_TABLES if append is None else append)
    res = JobResult(main)
    t = dict(main.tables)
    for name, how in modes.items():
        if not main.has(name):
            continue
        how = {"mode": how} if isinstance(how, str) else how
        srcs = [(s, s.table(name)) for s in subs if s.has(name)]
        if srcs or how.get("mode") == "empty" or name in ZONED_TABLES:
            t[name] = _append_table(main.table(name), main.zone, srcs, main.spec(name).keys, how, ZONE if name in ZONED_TABLES else None)
    for s in subs:
        for name in s.names():
            how = modes.get(name)
            res.actions.append((s.name, name, "not listed" if how is None else "missing" if not main.has(name) else
                                "emptied" if how == "empty" or not isinstance(how, str) and how.get("mode") == "empty" else "appended"))
    cur = Tenant(main.name, zid, t, main.specs)
    ledgers = []

    def has(*names):
        return all(cur.has(n) for n in names)

    # 1. duplicate player names outside the target zone; copies of the name follow
    if has("t_player_info"):
        renamed, ren = N.rename_duplicates(cur.table("t_player_info"), "name", "zoneid", zid, id_col="guid")
        ren = cut_lineage(ren)
        upd = {"t_player_info": renamed}
        for tb, on, col in PLAYER_NAME_COPIES:
            if cur.has(tb):
                upd[tb] = N.cascade(upd.get(tb, cur.table(tb)), on, col, ren)
        cur = cur.with_tables(upd)
        ledgers.append(_ledger(N.rename_ledger(ren, 1), guid="guid"))
    # 2. duplicate adventure-team names: ledger to the account id
    if has("t_account") and "adventure_team_name" in cur.table("t_account").columns:
        renamed, ren = N.rename_duplicates(cur.table("t_account"), "adventure_team_name", ZONE, zid, id_col="guid",
                                           where="adventure_team_name <> ''", only="accid <> 0", extra=["accid"])
        ren = cut_lineage(ren)
        cur = cur.with_tables({"t_account": renamed})
        ledgers.append(_ledger(ren.select("accid", F.col("new_name").alias("name"), F.lit(3).alias("type")),
                               accid="accid"))
    # 3. team data: children of accounts that lose the tie classes are deleted
    if has("t_account") and {"adventure_team_level", "adventure_team_exp"} <= set(cur.table("t_account").columns) \
            and any(cur.has(tb) for tb in TEAM_DATA_CHILDREN):
        keep = cut_lineage(I.tie_classes(cur.table("t_account"), "accid",
                                         ["adventure_team_level", "adventure_team_exp"], ZONE, zid, "guid"))
        cur = cur.with_tables({tb: I.delete_orphans(cur.table(tb), "acc_guid", keep, only=only)
                               for tb, only in TEAM_DATA_CHILDREN.items() if cur.has(tb)})
    # 4. adventure: one row per account, shop-70 purchases of other rows deleted
    if has("t_account_adventure"):
        adv = cut_lineage(I.survivors(cur.table("t_account_adventure"), "accid",
                                      [("seasonid", "desc"), ("level", "desc"), ("exp", "desc"), "guid"],
                                      prefer=F.col(ZONE) == zid))
        upd = {"t_account_adventure": adv}
        if cur.has("t_account_shop_acc_buy_record"):
            upd["t_account_shop_acc_buy_record"] = I.delete_losers(
                cur.table("t_account_shop_acc_buy_record"), "owner", "acc_guid",
                I.keep_map(adv, "accid", "guid"), only="shop_id = 70")
        cur = cur.with_tables(upd)
    # 5. hire: the side with fewer purchases loses its shop-34 rows; type-10 counters collapse
    if has("t_hire", "t_account", "t_account_shop_acc_buy_record"):
        hire = cur.table("t_hire")
        cur = cur.with_tables({"t_account_shop_acc_buy_record": I.keep_richer_side(
            hire, cur.table("t_account"), cur.table("t_account_shop_acc_buy_record"), zid)})
        if cur.has("t_account_counter"):
            dup = hire.groupBy("accid").agg(F.count(F.lit(1)).alias("__h")).where("__h > 1") \
                .select(F.col("accid").alias("__dup"))
            c = cur.table("t_account_counter")
            marked = c.join(dup, c["owner"] == dup["__dup"], "left")
            hit = (F.col("counter_type") == 10) & F.col("__dup").isNotNull()
            folded = I.collapse_counters(marked.withColumn("__hit", hit), "owner", "counter_num", "acc_guid",
                                         where=F.col("__hit"))
            cur = cur.with_tables({"t_account_counter": folded.drop("__dup", "__hit")})
    # 6. monopoly: coins summed into the surviving row
    if has("t_account_monopoly"):
        cur = cur.with_tables({"t_account_monopoly": I.fold(
            cur.table("t_account_monopoly"), "accid", [("vsersion", "desc"), ("roll_times", "desc"), "guid"],
            _present(res, "t_account_monopoly", cur.table("t_account_monopoly"), {"coin": "sum"}), prefer=F.col(ZONE) == zid)})
    # 7. accounts: fold into the survivor, re-point account foreign keys
    if has("t_account"):
        acc = cur.table("t_account")
        order = [(c, "desc") for c in ("adventure_team_level", "adventure_team_exp") if c in acc.columns] + ["guid"]
        folded = cut_lineage(I.fold(acc, "accid", order, _present(res, "t_account", acc, ACCOUNT_FOLDS), prefer=F.col(ZONE) == zid))
        keep = I.keep_map(folded, "accid", "guid")
        upd = {"t_account": folded}
        for tb, set_col, on_col in ACCOUNT_REPOINTS:
            if cur.has(tb):
                upd[tb] = I.repoint(upd.get(tb, cur.table(tb)), set_col, on_col, keep)
        cur = cur.with_tables(upd)
    # 8. dungeon hardness: max into the smallest guid per (account, dungeon)
    if has("t_g_dungeon_hard"):
        cur = cur.with_tables({"t_g_dungeon_hard": I.fold(cur.table("t_g_dungeon_hard"), ["account", "dungeon_id"],
                                                          ["guid"], {"unlocked_hard_type": "max"})})
    # 9. guilds: duplicate names outside the target zone (zone in the guid), ledger to the leader
    if has("t_guild"):
        renamed, ren = N.rename_guilds(cur.table("t_guild"), "name", "guid", zid)
        ren = cut_lineage(ren)
        upd = {"t_guild": renamed}
        if cur.has("t_guild_member"):
            ledgers.append(_ledger(N.guild_ledger(ren, cur.table("t_guild_member")), guid="guid"))
        if cur.has("t_sortlist"):
            upd["t_sortlist"] = N.cascade(cur.table("t_sortlist"), "id", "name", ren)
        cur = cur.with_tables(upd)
    # 10. resets, optional purge, final zone, lineage dropped
    cur = R.reset(cur, R.APPEND_RECONCILE_RESETS)
    if purge_as_of is not None and has("t_player_info"):
        cur = R.purge(cur, "t_player_info", "guid", R.inactive_player(purge_as_of), INACTIVE_PLAYER_CASCADE)
    if has("t_player_info"):
        cur = cur.with_tables({"t_player_info": R.final_zone(cur.table("t_player_info"), ["zoneid"], zid, drop=())})
    cur = cur.with_tables({tb: cur.table(tb).drop(ZONE) for tb in ZONED_TABLES if cur.has(tb)})
    for led in ledgers:
        old = cur.tables.get("t_merge_give_namecard")
        cur = cur.with_tables({"t_merge_give_namecard": led if old is None else old.unionByName(M.align(led, old, allow_missing=True))})
    res.main = cur
    return res
