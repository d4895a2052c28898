"""The append-and-reconcile job end to end on the F5 fixture shape."""

from datetime import datetime

from shardfold.model import Tenant
from shardfold.plans.reconcile import reconcile
from helpers import rows

G1 = (1 << 54) + 1
G2 = (2 << 54) + 5


def tenant(spark, zone, players, accounts, guilds, members, sortlist, counters, hire, records):
    return Tenant(f"s{zone}", zone, {
        "t_player_info": spark.createDataFrame(players, "guid bigint, name string, zoneid int, level int, savetime bigint, "
                                                        "totleonlinetime bigint, totlechargenum bigint, deletetime bigint"),
        "t_account": spark.createDataFrame(accounts, "guid bigint, accid bigint, adventure_team_name string, "
                                                     "adventure_team_level int, adventure_team_exp bigint, point bigint, "
                                                     "weapon_lease_tickets bigint, reg_time bigint"),
        "t_guild": spark.createDataFrame(guilds, "guid bigint, name string, enroll_terrid int, battle_score bigint, "
                                                 "occupy_terrid int, inspire int"),
        "t_guild_member": spark.createDataFrame(members, "guid bigint, guildid bigint, name string, post int"),
        "t_sortlist": spark.createDataFrame(sortlist, "id bigint, ownerid bigint, name string, ownername string, sorttype int"),
        "t_account_counter": spark.createDataFrame(counters, "acc_guid bigint, owner bigint, counter_type int, counter_num bigint"),
        "t_hire": spark.createDataFrame(hire, "accid bigint"),
        "t_account_shop_acc_buy_record": spark.createDataFrame(records, "acc_guid bigint, owner bigint, shop_id int"),
    }, {"t_player_info": "guid", "t_account": "guid", "t_guild": "guid"})


def test_reconcile_end_to_end(spark):
    old = int(datetime(2020, 1, 1).timestamp()) * 1000
    main = tenant(spark, 1,
                  players=[(1, "ann", 1, 50, old, 10, 0, 0), (2, "dup", 1, 50, old, 10, 0, 0)],
                  accounts=[(10, 100, "team", 5, 100, 3, 150, 9), (11, 200, "solo", 1, 1, 1, 1, 9)],
                  guilds=[(G1, "red", 3, 9, 1, 1)],
                  members=[(1, G1, "ann", 13)],
                  sortlist=[(9, 9, "x", "x", 17)],
                  counters=[(10, 100, 1, 3), (10, 100, 10, 4)],
                  hire=[(100,)],
                  records=[(10, 100, 34), (10, 100, 5)])
    sub = tenant(spark, 2,
                 players=[(3, "dup", 2, 10, old, 10, 0, 0), (4, "cy", 2, 50, old, 10, 0, 0)],
                 accounts=[(20, 100, "team", 5, 100, 4, 120, 5), (21, 300, "team", 2, 2, 1, 1, 9)],
                 guilds=[(G2, "red", 3, 9, 1, 1)],
                 members=[(5, G2, "cy", 13)],
                 sortlist=[(3, 3, "dup", "dup", 1), (G2, 4, "red", "cy", 2)],
                 counters=[(20, 100, 1, 5), (20, 100, 9, 2), (20, 100, 10, 6)],
                 hire=[(100,)],
                 records=[(20, 100, 34)])
    out = reconcile(main, [sub]).main
    assert rows(out.table("t_player_info"), "guid", "name", "zoneid") == [
        (1, "ann", 1), (2, "dup", 1), (3, "s2.dup", 1), (4, "cy", 1)]
    assert rows(out.table("t_account"), "guid", "accid", "adventure_team_name", "point", "weapon_lease_tickets",
                "reg_time") == [(10, 100, "team", 7, 200, 5), (11, 200, "solo", 1, 1, 9), (21, 300, "s2.team", 1, 1, 9)]
    assert "zone_id" not in out.table("t_account").columns
    # append keeps counter types 1-6 and 10 only (type 9 never arrives); team data: acc_guid 20 lost its
    # type-1 row; type 10 collapsed for the hire owner and re-pointed to the surviving account
    assert rows(out.table("t_account_counter")) == [(10, 100, 1, 3), (10, 100, 10, 10)]
    # hire: main has 2 records vs 1 -> the sub side's shop-34 row goes; then re-pointed
    assert rows(out.table("t_account_shop_acc_buy_record")) == [(10, 100, 5), (10, 100, 34)]
    assert rows(out.table("t_guild"), "guid", "name", "enroll_terrid") == [(G1, "red", 0), (G2, "s2.red", 0)]
    assert rows(out.table("t_sortlist"), "id", "name", "ownername") == [(3, "s2.dup", "s2.dup"), (G2, "s2.red", "cy")]
    assert rows(out.table("t_merge_give_namecard")) == [
        (3, None, "s2.dup", 1), (5, None, "cy", 2), (None, 100, "s2.team", 3), (None, 300, "s2.team", 3)]
    purged = reconcile(main, [sub], purge_as_of=datetime(2024, 1, 1)).main
    assert rows(purged.table("t_player_info"), "guid") == [(1,), (2,), (4,)]
    assert rows(purged.table("t_sortlist"), "id") == [(G2,)]
