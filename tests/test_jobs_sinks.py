"""R1-R5 jobs, rule types 1/2/3 (K10) and the versioned sink."""

import copy
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shardfold.model import Tenant
from shardfold.plans import jobs as J
from shardfold.plans.remap import remap
from shardfold.sources.catalog import has_column, list_parquet_tables, parquet_tenant
from shardfold.sources import sinks
from shardfold.sources.sinks import merge_report, read_published, write_tenant
from helpers import rows


def f1_tenant(spark, name, zone, names=("ann", "bob")):
    players = spark.createDataFrame(
        [(1, names[0], "acc1", 1, zone, "2"), (2, names[1], "acc2", None, zone, "1,12"), (12, "skip", "a12", 1, zone, "1")],
        "dbid bigint, name string, account string, guildid bigint, serverid int, friend_data string")
    roles = spark.createDataFrame([(1, 1), (2, 12)], "dbid bigint, playerid bigint")
    guild = spark.createDataFrame([(1, "g", zone, "1,2")], "dbid bigint, name string, serverid int, players string")
    log = spark.createDataFrame([(zone,)], "v int")
    return Tenant(name, zone, {"players": players, "roles": roles, "guild": guild, "log": log},
                  {"players": "dbid", "roles": "dbid", "guild": "dbid"})


RULES2 = {
    "type": "2",
    "same": [{"group": [{"db_table": "players", "db_field": "dbid"}, {"db_table": "roles", "db_field": "playerid"}]},
             {"group": [{"db_table": "guild", "db_field": "dbid"}, {"db_table": "players", "db_field": "guildid"}]}],
    "other_identity": [{"db_table": "roles", "db_field": "dbid"}],
    "special_option": {"teshudb_field_open": "1", "special_field_open": "0",
                       "teshudb_field": [{"db_table": "players", "db_field": "friend_data", "group": "1", "type": "1",
                                          "db_table_attribution": "players", "db_field_attribution": "dbid"},
                                         {"db_table": "guild", "db_field": "players", "group": "1", "type": "1",
                                          "db_table_attribution": "players", "db_field_attribution": "dbid"}]},
    "un_merge": [{"db_table": "log"}],
    "prefix_setting": {"role_is": "1", "guild_is": "1", "repeat_modify": "1", "additional_string": "1", "prefix": "s2.",
                       "role_name": [{"db_table": "players", "db_field": "name", "not_equal": "skip"}],
                       "guild_name": [{"db_table": "guild", "db_field": "name", "not_equal": ""}]},
    "server_info": {"server_is": "1", "server_sql": [{"db_table": "players", "db_field": "serverid"},
                                                     {"db_table": "guild", "db_field": "serverid"}]},
}


def test_rule_type2_end_to_end(spark):
    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2, ("bob", "cy"))
    before = copy.deepcopy(RULES2)
    res = J.run_rules(main, [J.SubTenant(sub, server_id=7, prefix="S2.")], RULES2)
    assert RULES2 == before  # H9: never mutated
    dflt = J.run_rules(main, [J.SubTenant(sub)], {**RULES2, "slave_server": "5"})
    assert {r.serverid for r in dflt.main.table("players").collect()} == {1, 5}
    p = rows(res.main.table("players"), "dbid", "name", "guildid", "serverid", "friend_data")
    assert p == [(1, "ann", 1, 1, "2"), (2, "bob", None, 1, "1,12"), (12, "skip", 1, 1, "1"),
                 (13, "S2.bob", 2, 7, "14"), (14, "cy", None, 7, "13,24"), (24, "skip", 2, 7, "13")]
    assert rows(res.main.table("roles")) == [(1, 1), (2, 12), (3, 13), (4, 24)]
    assert rows(res.main.table("guild"), "dbid", "name", "players") == [(1, "g", "1,2"), (2, "S2.g", "13,14")]
    assert rows(res.main.table("log")) == [(1,)]  # excluded table: main's rows only
    assert ("sub", "log", "excluded") in res.actions


def test_rule_type1_and_index_errors(spark):
    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2)
    r1 = {"type": 1, "other_identity": [{"db_table": "players", "db_field": "dbid"}]}
    res = remap(main, sub, r1)
    assert res.other_offsets == [12] and rows(res.sub.table("players"), "dbid") == [(13,), (14,), (24,)]
    bad = {**RULES2, "special_option": {"special_field_open": "1", "special_field": [
        {"db_table": "players", "db_field": "guildid", "group": "2", "type": "5", "conditions": ""}]}}
    with pytest.raises(IndexError):
        remap(main, sub, bad)  # H18
    with pytest.raises(ValueError):
        remap(main, sub, {"type": "9"})


def test_rule_type3_widen_and_ignored(spark):
    def t(name, base):
        return Tenant(name, 1, {
            "character": spark.createDataFrame([(base + 1, 1)], "characterid int, serverid int"),
            "bag": spark.createDataFrame([(1, base + 1)], "autoid bigint, characterid int")})
    rules = {"type": "3", "simple_process": {"character_types": "1",
                                             "deal_with": [{"db_table": "character", "db_field": "characterid",
                                                            "associated": "characterid"}],
                                             "primary_key": [{"db_field": "autoid"}]},
             "special_option": {"teshudb_field": [{"db_table": "bag"}]}}
    res = remap(t("m", 10), t("s", 0), rules)
    assert dict(res.sub.table("bag").dtypes)["characterid"] == "bigint"
    assert rows(res.sub.table("bag")) == [(2, 12)]
    assert res.ignored == ["special_option.teshudb_field"]


def test_account_relink_rule(spark):
    def t(name, users, players):
        return Tenant(name, 1, {"user": spark.createDataFrame(users, "id bigint, user_name string"),
                                "player": spark.createDataFrame(players, "player_id bigint, user_id bigint")},
                      {"user": "id", "player": "player_id"})
    main = t("m", [(1, "ann"), (2, "bob")], [(1, 1), (2, 2)])
    sub = t("s", [(1, "bob"), (2, "cy")], [(1, 1), (2, 2)])
    rules = {"type": "2",
             "same": [{"group": [{"db_table": "user", "db_field": "id"}, {"db_table": "player", "db_field": "user_id"}]}],
             "other_identity": [{"db_table": "player", "db_field": "player_id"}],
             "prefix_setting": {"account_change": "999", "account_change_new": [
                 {"db_table_user": "user", "db_field_user_id": "id", "db_field_user_name": "user_name",
                  "db_table_player": "player", "db_field_player_user_id": "user_id"}]}}
    res = J.run_rules(main, [J.SubTenant(sub)], rules)
    assert rows(res.main.table("user")) == [(1, "ann"), (2, "bob"), (4, "cy")]
    assert rows(res.main.table("player")) == [(1, 1), (2, 2), (3, 2), (4, 4)]


def test_two_subs_see_merged_main(spark):
    main = f1_tenant(spark, "main", 1)
    s2, s3 = f1_tenant(spark, "s2", 2, ("bob", "dan")), f1_tenant(spark, "s3", 3, ("dan", "eve"))
    rules = {"type": "1", "other_identity": [{"db_table": "players", "db_field": "dbid"}],
             "prefix_setting": {"role_is": "1", "repeat_modify": "1", "additional_string": "1", "prefix": "x",
                                "role_name": [{"db_table": "players", "db_field": "name", "not_equal": "skip"}]}}
    res = J.run_rules(main, [J.SubTenant(s2, prefix="b."), J.SubTenant(s3, prefix="c.")], rules)
    names = sorted(r.name for r in res.main.table("players").collect())
    # H25: "dan" of s3 conflicts with s2's "dan", merged into main before s3
    assert names == sorted(["ann", "bob", "skip", "b.bob", "dan", "skip", "c.dan", "eve", "skip"])
    ids = [r.dbid for r in res.main.table("players").collect()]
    assert len(ids) == len(set(ids))


def test_exclusion_filtered_relabel_append(spark):
    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2)
    r2 = J.exclusion_merge(main, [sub], exclude=["log"])
    assert rows(r2.main.table("players"), "dbid", "serverid") == [(1, 2), (2, 2), (12, 2)]
    r3 = J.filtered_merge(main, [sub], {"players": "dbid = 12", "nope": "TRUE", "roles": ""})
    assert rows(r3.main.table("players"), "dbid", "serverid") == [(1, 1), (2, 1), (12, 2)]
    assert r3.main.table("roles").count() == 2
    r4 = J.relabel_merge(main, [sub], exclude=["log"], name_cols=[("players", "name")],
                         zone_cols=[("players", "serverid")])
    assert rows(r4.main.table("players"), "dbid", "name", "serverid")[0] == (1, "s2ann", 1)
    login = Tenant("login", 0, {"srv": spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "uid bigint, loginserver_id int")})
    cfg = Tenant("cfg", 0, {"t_server": spark.createDataFrame(
        [(2, 0, "p", "r", "db2"), (2, 1, "p", "r", "db2"), (1, 0, "p", "r", "db1")],
        "serverId int, serverType int, serverPort string, serverRemotePort string, serverDBName string")})
    r4b = J.relabel_merge(main, [sub, f1_tenant(spark, "s3", 3)], exclude=["log"], login=(login, "srv", "loginserver_id"),
                          merge_record=True, server_config=(cfg, "t_server", {"serverPort": "9000",
                                                                             "serverDBName": "main"}))
    assert rows(r4b.extra["login"].table("srv")) == [(1, 1), (2, 1), (3, 1)]
    assert rows(r4b.extra["t_merge_record"]) == [(1, 2, 1, 1), (1, 3, 1, 1)]
    assert rows(r4b.extra["server_config"].table("t_server")) == [
        (1, 0, "p", "r", "db1"), (2, 0, "9000", "r", "main"), (2, 1, "p", "r", "db2")]
    acc = lambda z, rows_: Tenant(f"z{z}", z, {"account": spark.createDataFrame(
        rows_, "guid bigint, accid bigint, level int, point bigint, name string")}, {"account": "guid"})
    t1 = acc(1, [(1, 100, 5, 1, "ann"), (2, 200, 9, 1, "bob")])
    t2 = acc(2, [(11, 100, 7, 2, "bob"), (12, 300, 1, 1, "cy")])
    spec = {"append": {"account": "error"},
            "names": [{"table": "account", "name": "name", "id": "guid", "ledger_type": 1}],
            "accounts": {"table": "account", "key": "accid", "id": "guid", "order": [("level", "desc"), "guid"],
                         "folds": {"point": "sum"}}}
    r5 = J.append_reconcile(t1, [t2], spec)
    assert rows(r5.main.table("account")) == [(1, 100, 5, 3, "ann"), (2, 200, 9, 1, "bob"), (12, 300, 1, 1, "cy")]
    assert rows(r5.main.table("ledger")) == [(11, "s2.bob", 1)]
    with pytest.raises(Exception):
        J.append_reconcile(t1, [acc(2, [(1, 5, 1, 1, "x")])], {"append": {"account": "error"}})


def test_write_tenant_versioned(spark):
    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2)
    merged, actions = J.M.merge_tenant(main, sub, exclude=["log"])
    out = tempfile.mkdtemp(prefix="shardfold-out-", dir="/tmp")
    counts = write_tenant(merged, out, "1", threads=2)
    assert counts["players"] == 3 and counts["log"] == 1
    back = read_published(spark, out, "1", "main", 1, merged.names())
    assert rows(back.table("players")) == rows(merged.table("players"))
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, "2", "main", 1, ["players"])
    rep = rows(merge_report(main, sub, merged, actions))
    assert ("sub", "players", "merged", 3, 3, 3, 3) in rep and ("sub", "log", "excluded", 1, 1, 1, 0) in rep
    assert has_column(back.table("players"), "friend_data")


def test_a_table_that_fails_while_it_runs_is_named_and_taken_up_again(spark):
    from pyspark.sql import functions as F

    out = tempfile.mkdtemp(prefix="shardfold-out-", dir="/tmp")
    good = spark.range(10)
    bad = spark.range(1, 5).select((F.lit(2147483647) + F.col("id").cast("int")).cast("int").alias("v"))  # overflows when it runs
    tenant = Tenant("m", 1, {"a": good, "b": bad, "c": good.limit(3)})
    with pytest.raises(sinks.TablesFailed) as told:
        write_tenant(tenant, out, "1")
    assert list(told.value.failed) == ["b"]
    entries = sinks.manifest(spark, out, "1")
    assert {t: (e["status"], e["rows"]) for t, e in entries.items()} == {"a": ("written", 10), "b": ("failed", None), "c": ("written", 3)}
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, "1", "m", 1, ["a"])
    read = []
    def seen(name):
        def note(batches):
            read.append(name)
            raise AssertionError(f"{name} is read again")
            yield from batches
        return spark.range(1).mapInPandas(note, "id bigint")
    counts = write_tenant(Tenant("m", 1, {"a": seen("a"), "b": spark.range(2), "c": seen("c")}), out, "1")
    assert counts == {"a": 10, "b": 2, "c": 3} and not read
    assert rows(read_published(spark, out, "1", "m", 1, ["a", "b"]).table("b")) == [(0,), (1,)]
    with pytest.raises(FileExistsError):
        write_tenant(tenant, out, "1")
    assert write_tenant(tenant, out, "2", publish="partial") == {"a": 10, "c": 3}
    assert rows(read_published(spark, out, "2", "m", 1, ["c"]).table("c")) == [(0,), (1,), (2,)]


def test_action_summary_counts_appends(spark):
    told = [("s", "a", "appended"), ("s", "b", "emptied"), ("s", "c", "not listed"), ("s", "d", "missing"), ("s", "a", "no column x"), ("t", "a", "copied"), ("t", "b", "failed")]
    assert rows(sinks.action_summary(spark, told)) == [("s", 2, 2, 0, 4), ("t", 1, 0, 1, 2)]


def test_parquet_tenant_reads_driver_tables(spark):
    d = "/root/testdata/sf0.001"
    names = list_parquet_tables(spark, d)
    assert {"customer", "orders", "lineitem"} <= set(names)
    t = parquet_tenant(spark, "t", 1, d, ["customer", "orders"], {"customer": "c_custkey"})
    assert t.spec("customer").primary == ("c_custkey",)
    assert t.table("orders").where(F.col("o_orderkey") == 0).count() == 1


def test_catalog_tenant_and_bucketed_merge_without_shuffle(spark):
    from shardfold.operators.merge import merge_replace
    from shardfold.sources.catalog import catalog_tenant, list_tables
    from shardfold.sources.sinks import save_bucketed

    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2)
    save_bucketed(main, "tm_main", 4, ["players", "log"])
    save_bucketed(sub, "tm_sub", 4, ["players"])
    spark.sql("CREATE OR REPLACE VIEW tm_main.players_v AS SELECT * FROM tm_main.players")
    assert list_tables(spark, "tm_main") == ["log", "players"]  # S5: the view is left out
    m = catalog_tenant(spark, "tm_main", 1, specs={"players": "dbid"})
    s = catalog_tenant(spark, "tm_sub", 2, specs={"players": "dbid"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge_replace(m.table("players"), s.table("players"), "dbid")
        assert rows(out, "dbid", "serverid") == [(1, 2), (2, 2), (12, 2)]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan


SENT = 4294967295


def f2_tenant(spark, name, base, roles):
    t = {
        "roledata": spark.createDataFrame([(base + i, base + 1, 300 if i == 1 else SENT, n, 0)
                                           for i, n in enumerate(roles, start=1)],
                                          "RoleID bigint, AccountID bigint, GuildID bigint, RoleName string, RoleNameCrc bigint"),
        "item": spark.createDataFrame([(1, base + 1, base + 1), (2, SENT, 300), (3, SENT, SENT)],
                                      "SerialNum bigint, OwnerID bigint, AccountID bigint"),
        "guild": spark.createDataFrame([(300, base + 1, base + 1)], "ID bigint, FounderNameID bigint, LeaderID bigint"),
        "guild_member": spark.createDataFrame([(300, base + 1)], "GuildID bigint, RoleID bigint"),
        "operatoractive": spark.createDataFrame([(1, 1), (2, 0)], "id bigint, opened int"),
        "chat": spark.createDataFrame([(1,)], "id bigint"),
    }
    return Tenant(name, 1, t, {"roledata": "RoleID", "item": "SerialNum", "guild": "ID", "operatoractive": "id"})


RULES_F2 = {
    "type": "2",
    "restructure_state": "1",
    "restructure_tool": [{"group": [
        {"db_table": "guild", "db_field": "ID", "conditions": ""},
        {"db_table": "guild_member", "db_field": "GuildID", "conditions": ""},
        {"db_table": "roledata", "db_field": "GuildID", "conditions": " AND GuildID != 4294967295"},
        {"db_table": "item", "db_field": "AccountID", "conditions": " AND OwnerID = 4294967295 AND AccountID != 4294967295"}]}],
    "same": [{"group": [{"db_table": "roledata", "db_field": "RoleID"}, {"db_table": "guild_member", "db_field": "RoleID"},
                        {"db_table": "guild", "db_field": "LeaderID"}]},
             {"group": [{"db_table": "guild", "db_field": "ID"}, {"db_table": "guild_member", "db_field": "GuildID"}]}],
    "other_identity": [{"db_table": "item", "db_field": "SerialNum"}],
    "special_option": {"special_field_open": "1", "special_field": [
        {"db_table": "item", "db_field": "OwnerID", "group": "1", "type": "1", "conditions": "where OwnerID != 4294967295"},
        {"db_table": "item", "db_field": "AccountID", "group": "1", "type": "2",
         "conditions": "where OwnerID = 4294967295 AND AccountID != 4294967295"}]},
    "simple_process": {"character_types": "1"},
    "empty_table": [{"db_table": "chat"}],
    "modify_table": [{"db_table": "operatoractive", "db_field": "opened", "results": "0", "conditions": "1"}],
    "un_merge": [],
    "prefix_setting": {"account_change": "1", "account_suffix": "_s2"},
}


def test_polymorphic_owner_rules(spark):
    main = f2_tenant(spark, "main", 0, ["ann", "bob"])
    sub = f2_tenant(spark, "sub", 10, ["cy"])
    acc_m = Tenant("am", 1, {"account": spark.createDataFrame([(1, "ann")], "id bigint, name string")}, {"account": "id"})
    acc_s = Tenant("as", 2, {"account": spark.createDataFrame([(1, "zed"), (2, "y_s2")], "id bigint, name string")},
                   {"account": "id"})
    res = J.run_rules(main, [J.SubTenant(sub, accounts=acc_s, account_suffix="_s2")], RULES_F2, main_accounts=acc_m, declared_tables=True)
    item = rows(res.main.table("item"))
    # main: guild 300 renumbered to 1 (sentinels untouched); sub serials shifted by 3, owner by role offset 11,
    # account (guild-typed, sentinel owner) renumbered then shifted by the guild offset 1
    assert item == [(1, 1, 1), (2, SENT, 1), (3, SENT, SENT), (4, 22, 11), (5, SENT, 2), (6, SENT, SENT)]
    assert rows(res.main.table("guild")) == [(1, 1, 1), (2, 11, 22)]
    # roledata.GuildID is renumbered (restructure group) but in no "same" group, so it is not shifted
    assert rows(res.main.table("roledata"), "RoleID", "GuildID") == [(1, 1), (2, SENT), (22, 1)]
    assert rows(res.main.table("operatoractive")) == [(1, 0), (2, 0)]
    assert res.main.table("chat").count() == 0
    assert rows(res.accounts.table("account")) == [(1, "zed_s2"), (2, "y_s2")]  # suffix only once
    plain = J.run_rules(main, [J.SubTenant(sub, accounts=acc_s)], RULES_F2, main_accounts=acc_m, declared_tables=True)
    assert rows(plain.accounts.table("account")) == [(1, "zed"), (2, "y_s2")]  # no suffix of the sub's own
    assert dict(res.main.table("guild_member").dtypes)["RoleID"] == "bigint"


def test_action_summary_and_zone_of(spark):
    from shardfold.operators.rows import zone_of
    from shardfold.sources.sinks import action_summary, lineage_rows

    main, sub = f1_tenant(spark, "main", 1), f1_tenant(spark, "sub", 2)
    res = J.run_rules(main, [J.SubTenant(sub)], {"type": "1", "un_merge": [{"db_table": "log"}]})
    assert rows(action_summary(spark, res.actions)) == [("sub", 3, 1, 0, 4)]
    assert zone_of(sub.table("players"), "serverid") == 2
    lin = lineage_rows(spark, [{"from_tenant": "sub", "to_tenant": "main", "zone": 1}])
    assert rows(lin) == [("sub", "main", 1)]


def test_append_reconcile_resets_preset(spark):
    from shardfold.operators.retention import APPEND_RECONCILE_RESETS, reset

    t = Tenant("t", 1, {
        "t_counter": spark.createDataFrame([(1, "jar_buy_dis_remain_501", 3), (1, "jar_buy_dis_remain_607", 3),
                                            (1, "buy_mall_fashion_num", 4), (1, "other", 5)],
                                           "owner bigint, name string, value bigint"),
        "t_sortlist": spark.createDataFrame([(1, 17), (2, 3)], "id bigint, sorttype int"),
        "t_blackmarket_auction": spark.createDataFrame([(0, 0), (0, 1)], "off_sale int, is_settled int")})
    out = reset(t, APPEND_RECONCILE_RESETS)
    assert rows(out.table("t_counter"), "name", "value") == [
        ("buy_mall_fashion_num", 0), ("jar_buy_dis_remain_501", 10), ("jar_buy_dis_remain_607", 50), ("other", 5)]
    assert rows(out.table("t_sortlist")) == [(2, 3)]
    assert rows(out.table("t_blackmarket_auction")) == [(0, 1), (1, 0)]


def test_append_reconcile_modes(spark):
    def t(zone, names, tx, counters, op):
        return Tenant(f"z{zone}", zone, {
            "t_player_info_name": spark.createDataFrame([(n,) for n in names], "name string"),
            "t_abnormal_transaction": spark.createDataFrame(tx, "guid bigint, payload string"),
            "t_account_counter": spark.createDataFrame(counters, "acc_guid bigint, counter_type int"),
            "t_activity_op": spark.createDataFrame(op, "id bigint"),
            "t_mail": spark.createDataFrame([(zone * 10,)], "owner bigint"),
        }, {"t_player_info_name": "name", "t_abnormal_transaction": "guid"})
    main = t(1, ["ann", "bob"], [(1, "a"), (5, "b")], [(1, 1)], [(1,)])
    sub = t(2, ["bob", "cy"], [(1, "c"), (2, "d")], [(2, 7), (3, 10)], [(2,)])
    res = J.append_reconcile(main, [sub], {"append": J.APPEND_RECONCILE_TABLES, "append_rest": True})
    m = res.main
    assert rows(m.table("t_player_info_name")) == [("ann",), ("bob",), ("cy",)]
    assert rows(m.table("t_abnormal_transaction")) == [(1, "a"), (5, "b"), (6, "c"), (7, "d")]
    assert rows(m.table("t_account_counter")) == [(1, 1), (3, 10)]
    assert m.table("t_activity_op").count() == 0 and m.table("t_activity_op").columns == ["id"]
    assert rows(m.table("t_mail")) == [(10,), (20,)]


@pytest.mark.parametrize("names", [False, True])
def test_many_subs_tracked_offsets_equal_checkpointed(spark, monkeypatch, names):
    main = f1_tenant(spark, "main", 1)
    subs = [f1_tenant(spark, f"s{z}", z, (f"a{z}", "ann" if z == 3 else f"b{z}")) for z in (2, 3, 4)]
    rules = RULES2 if names else {k: v for k, v in RULES2.items() if k != "prefix_setting"}
    exact = J.run_rules(main, [J.SubTenant(s, server_id=s.zone) for s in subs], rules, checkpoint_between=True)
    calls = []
    real = J.cut_lineage
    monkeypatch.setattr(J, "cut_lineage", lambda df: calls.append(df.columns) or real(df))
    tracked = J.run_rules(main, [J.SubTenant(s, server_id=s.zone) for s in subs], rules)
    # only name columns are materialised between subs, never main's tables
    assert calls == ([["name"]] * 2 if names else [])
    for t in ("players", "roles", "guild", "log"):
        assert rows(tracked.main.table(t)) == rows(exact.main.table(t))
    assert len(rows(tracked.main.table("players"))) == 12


def test_command_line_run(spark):
    import json
    from shardfold.plans import run as R

    base = tempfile.mkdtemp(prefix="shardfold-cli-", dir="/tmp")
    for name, zone in (("main", 1), ("sub", 2)):
        t = f1_tenant(spark, name, zone)
        for tb in ("players", "roles", "guild"):
            t.table(tb).write.parquet(f"{base}/{name}/{tb}.parquet")
    rules = {"script": {k: v for k, v in RULES2.items() if k not in ("un_merge",)}}
    with open(f"{base}/rules.json", "w") as fh:
        json.dump(rules, fh)
    counts = R.main(["--rules", f"{base}/rules.json", "--main", f"{base}/main", "--sub", f"{base}/sub:2:S2.",
                     "--keys", "players=dbid", "--keys", "roles=dbid", "--keys", "guild=dbid",
                     "--out", f"{base}/out", "--version", "1"], spark=spark)
    assert counts == {"guild": 2, "players": 6, "roles": 4}
    back = read_published(spark, f"{base}/out", "1", "m", 1, ["players"])
    assert "S2.bob" in [r.name for r in back.table("players").collect()]


def test_command_line_other_jobs(spark):
    from shardfold.plans import run as R

    base = tempfile.mkdtemp(prefix="shardfold-cli2-", dir="/tmp")
    for name, zone in (("main", 1), ("sub", 2)):
        t = f1_tenant(spark, name, zone)
        for tb in ("players", "log"):
            t.table(tb).write.parquet(f"{base}/{name}/{tb}.parquet")
    common = ["--main", f"{base}/main", "--sub", f"{base}/sub:2", "--keys", "players=dbid"]
    c = R.main(["--job", "relabel", *common, "--name-col", "players.name", "--zone-col", "players.serverid",
                "--exclude", "log", "--out", f"{base}/out", "--version", "r"], spark=spark)
    assert c == {"log": 1, "players": 3}
    back = read_published(spark, f"{base}/out", "r", "m", 1, ["players"]).table("players")
    assert rows(back, "name", "serverid")[0] == ("s2ann", 1)
    c = R.main(["--job", "filtered", *common, "--filter", "players=dbid = 12", "--out", f"{base}/out",
                "--version", "f"], spark=spark)
    assert c["players"] == 3
