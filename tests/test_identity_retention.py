"""I1-I18 on the F4/F5/F6 fixture shapes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shardfold.model import Tenant
from shardfold.operators import identity as I
from shardfold.operators import retention as R
from helpers import rows


@pytest.fixture
def accounts(spark):
    """F5 t_account: guid, accid, zone_id, level, exp, point, reg_time, tickets."""
    return spark.createDataFrame([
        (10, 1, 1, 5, 100, 3, 50, 150),     # accid 1: both zones, same level/exp
        (20, 1, 2, 5, 100, 4, 40, 120),
        (11, 2, 1, 3, 10, None, 60, 10),   # accid 2: zones differ on level
        (21, 2, 2, 9, 10, None, 30, 20),
        (22, 3, 2, 1, 1, 7, 10, 300),      # accid 3: single row, tickets above cap stay
        (23, 4, 2, 2, 5, 1, 5, 1),         # accid 4: only sub zones, tie on level -> exp
        (24, 4, 3, 2, 9, 2, 6, 1),
    ], "guid bigint, accid bigint, zone_id int, level int, exp bigint, point bigint, reg_time bigint, tickets bigint")


def test_survivors_prefer_main_then_order(accounts):
    s = I.survivors(accounts, "accid", [("level", "desc"), ("exp", "desc"), "guid"], prefer=F.col("zone_id") == 1)
    assert rows(s, "accid", "guid") == [(1, 10), (2, 11), (3, 22), (4, 24)]
    s2 = I.survivors(accounts, "accid", [("level", "desc"), ("exp", "desc"), "guid"])
    assert rows(s2, "accid", "guid") == [(1, 10), (2, 21), (3, 22), (4, 24)]


def test_fold_sum_min_max_cap(accounts):
    f = I.fold(accounts, "accid", [("level", "desc"), ("exp", "desc"), "guid"],
               {"point": "sum", "reg_time": "min", "exp": "max", "tickets": ("sum_capped", 200)},
               prefer=F.col("zone_id") == 1)
    got = {r.accid: r for r in f.collect()}
    assert (got[1].guid, got[1].point, got[1].reg_time, got[1].tickets) == (10, 7, 40, 200)
    assert got[2].point == 0  # COALESCE(SUM(NULL), 0)
    assert (got[3].tickets, got[3].point) == (300, 7)  # single rows untouched
    assert f.count() == 4 and f.columns == accounts.columns
    # totals of summed columns are preserved over the duplicated keys
    assert sum(r.point for r in f.collect() if r.accid in (1, 4)) == 3 + 4 + 1 + 2


def test_sum_and_max_to_first(spark):
    rec = spark.createDataFrame([(5, 1, 7, 2), (3, 1, 7, 4), (9, 2, 1, None)], "guid bigint, owner bigint, dungeon int, n bigint")
    s = I.fold(rec, "owner", ["guid"], {"n": "sum"}, only_duplicates=False)
    assert rows(s, "guid", "owner", "n") == [(3, 1, 6), (9, 2, 0)]
    m = I.fold(rec, ["owner", "dungeon"], ["guid"], {"n": "max"}, only_duplicates=False)
    assert rows(m, "guid", "n") == [(3, 4), (9, None)]


def test_repoint_and_delete_losers(spark, accounts):
    keep = I.keep_map(I.survivors(accounts, "accid", ["guid"]), "accid", "guid")
    child = spark.createDataFrame([(1, 20, 70), (1, 10, 70), (2, 21, 1), (2, None, 70), (9, 5, 70)],
                                  "owner bigint, acc_guid bigint, shop_id int")
    rp = I.repoint(child, "acc_guid", "owner", keep)
    assert rows(rp) == [(1, 10, 70), (1, 10, 70), (2, 11, 1), (2, 11, 70), (9, 5, 70)]
    dl = I.delete_losers(child, "owner", "acc_guid", keep, only="shop_id = 70")
    assert rows(dl) == [(1, 10, 70), (2, 21, 1), (2, None, 70), (9, 5, 70)]


def test_delete_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 1)], "acc_guid bigint, counter_type int")
    keep = spark.createDataFrame([(1,)], "guid bigint")
    assert rows(I.delete_orphans(child, "acc_guid", keep)) == [(1, 1)]
    # rows outside the filter (NULL type included) stay whatever their key
    assert rows(I.delete_orphans(child, "acc_guid", keep, only="counter_type IN (1, 2)")) == [(1, 1), (3, None)]
    assert rows(I.delete_orphans(child, "acc_guid", keep, only="counter_type = 2")) == [(1, 1), (3, None), (4, 1)]


def test_relink_accounts(spark):
    """same user name on both sides: sub children take main's id, duplicate user row goes."""
    main_u = spark.createDataFrame([(1, "ann"), (2, "bob")], "id bigint, user_name string")
    sub_u = spark.createDataFrame([(101, "bob"), (102, "cy")], "id bigint, user_name string")
    player = spark.createDataFrame([(1, 101), (2, 102)], "player_id bigint, user_id bigint")
    pay = spark.createDataFrame([(101, 5), (101, None)], "user_id bigint, amount bigint")
    users, kids = I.relink_accounts(main_u, sub_u, "id", "user_name",
                                    {"player": (player, "user_id"), "player_pay": (pay, "user_id")})
    assert rows(users) == [(102, "cy")]
    assert rows(kids["player"]) == [(1, 2), (2, 102)]
    assert rows(kids["player_pay"]) == [(2, 5), (2, None)]
    dup = spark.createDataFrame([(7, "bob"), (8, "bob")], "id bigint, user_name string")
    with pytest.raises(Exception, match="duplicate user name"):
        I.relink_accounts(main_u, dup, "id", "user_name", {"player": (player, "user_id")})[1]["player"].collect()


def test_tie_classes(accounts):
    keep = I.tie_classes(accounts, "accid", ["level", "exp"], "zone_id", 1, "guid")
    assert rows(keep) == [(10,), (21,), (22,), (24,)]


def test_keep_richer_side(spark):
    hire = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,)], "accid bigint")
    acc = spark.createDataFrame([(10, 1, 1), (20, 1, 2), (11, 2, 1), (21, 2, 2), (13, 3, 1), (23, 3, 2)],
                                "guid bigint, accid bigint, zone_id int")
    rec = spark.createDataFrame([
        (1, 10, 34), (1, 10, 5), (1, 20, 34),        # main richer: sub's shop-34 row goes
        (2, 21, 34), (2, 11, 34),                    # accid 2 has one hire row: untouched
        (3, 13, 34), (3, 23, 34)], "owner bigint, acc_guid bigint, shop_id int")   # tie: main's goes
    out = I.keep_richer_side(hire, acc, rec, 1)
    assert rows(out) == [(1, 10, 5), (1, 10, 34), (2, 11, 34), (2, 21, 34), (3, 23, 34)]


def test_collapse_counters(spark):
    c = spark.createDataFrame([(1, 7, 10, 2), (2, 7, 10, 3), (3, 7, 1, 9), (4, 8, 10, None)],
                              "id bigint, owner bigint, counter_type int, counter_num bigint")
    out = I.collapse_counters(c, "owner", "counter_num", "id", where="counter_type = 10")
    assert rows(out) == [(1, 7, 10, 5), (3, 7, 1, 9), (4, 8, 10, 0)]


@pytest.fixture
def f6(spark):
    actors = spark.createDataFrame([(1, 5, datetime(2020, 1, 1), 1), (2, 50, datetime(2020, 1, 1), 1),
                                    (3, 5, datetime(2024, 1, 1), 1), (4, None, None, 1)],
                                   "actorid bigint, level int, updatetime timestamp_ntz, serverindex int")
    bag = spark.createDataFrame([(1,), (2,), (3,), (None,)], "actorid bigint")
    guild = spark.createDataFrame([(1,), (4,)], "actorid bigint")
    props = spark.createDataFrame([(1, -1), (2, 3), (3, None)], "playerId bigint, backpack int")
    return Tenant("t", 1, {"actors": actors, "actorbagitem": bag, "actorguild": guild, "userprops": props})


def test_purge_cascade(f6):
    out = R.purge(f6, "actors", "actorid", "level < 30 AND updatetime < TIMESTAMP_NTZ'2023-01-01 00:00:00'",
                  {"actorbagitem": "actorid", "actorguild": ["actorid"]})
    assert rows(out.table("actors"), "actorid") == [(2,), (3,), (4,)]
    assert rows(out.table("actorbagitem")) == [(2,), (3,), (None,)]
    assert rows(out.table("actorguild")) == [(4,)]


def test_purge_two_columns(spark):
    rel = spark.createDataFrame([(1, 2), (3, 1), (3, 4), (None, 5)], "owner bigint, id bigint")
    purged = spark.createDataFrame([(1,)], "guid bigint")
    assert rows(R.purge_children(rel, ["owner", "id"], purged)) == [(3, 4), (None, 5)]


def test_purge_from_spec(f6):
    spec = {"state": "1", "level": "30", "day": "365",
            "conditions": [{"type": "1", "db_table": "actors", "db_field": "level", "common": "actorid"},
                           {"type": "2", "db_table": "actors", "db_field": "updatetime", "common": "actorid",
                            "time_format": "1"}],
            "cleaning_table": [{"db_table": "actorbagitem", "db_field": "actorid"},
                               {"db_table": "actorguild", "db_field": "actorid"}],
            "all_clear": [{"db_table": "userprops", "db_field": "backpack", "conditions": "<0"}]}
    out = R.purge_from_spec(f6, spec, datetime(2024, 6, 1))
    assert rows(out.table("actors"), "actorid") == [(2,), (3,), (4,)]
    assert rows(out.table("actorbagitem")) == [(2,), (3,), (None,)]
    assert rows(out.table("userprops")) == [(2, 3), (3, None)]
    assert R.purge_from_spec(f6, {**spec, "state": "0"}, datetime(2024, 6, 1)) is f6


def test_inactive_player_predicate(spark):
    now = datetime(2024, 3, 1)
    day = 24 * 3600 * 1000
    p = spark.createDataFrame([
        (1, 0, int(datetime(2024, 1, 1).timestamp()) * 1000, 10, 100, 0),
        (2, 0, int(datetime(2024, 2, 25).timestamp()) * 1000, 10, 100, 0),
        (3, 0, int(datetime(2024, 1, 1).timestamp()) * 1000 - day, 40, 100, 0),
        (4, 0, int(datetime(2024, 1, 1).timestamp()) * 1000, 10, 100, 5)],
        "guid bigint, deletetime bigint, savetime bigint, level int, totleonlinetime bigint, totlechargenum bigint")
    assert rows(p.where(R.inactive_player(now)), "guid") == [(1,)]


def test_reset_and_final_zone(spark):
    t = Tenant("t", 1, {"auction": spark.createDataFrame([(1, 5, 2), (2, 7, 3)], "id bigint, duetime bigint, zone_id int")})
    out = R.reset(t, {"auction": [("set", "duetime", 0, None), ("set", "duetime", 9, "id = 2"), ("delete", "id = 1")],
                      "missing": [("delete", "TRUE")]})
    assert rows(out.table("auction")) == [(2, 9, 3)]
    fz = R.final_zone(out.table("auction").withColumn("zoneid", F.lit(3)), ["zoneid"], 1)
    assert fz.columns == ["id", "duetime", "zoneid"] and rows(fz, "zoneid") == [(1,)]


def test_survivor_null_order_like_mysql(spark):
    df = spark.createDataFrame([(1, 1, None, "b"), (2, 1, 5, "a"), (3, 2, None, None), (4, 2, 3, "c")],
                               "id bigint, k bigint, lvl int, s string")
    # DESC puts NULL last: the row with a level wins
    assert rows(I.survivors(df, "k", [("lvl", "desc"), "id"]), "k", "id") == [(1, 2), (2, 4)]
    # ASC puts NULL first
    assert rows(I.survivors(df, "k", [("lvl", "asc"), "id"]), "k", "id") == [(1, 1), (2, 3)]
    # string descending (max path) with a numeric ascending tiebreak
    assert rows(I.survivors(df, "k", [("s", "desc"), "id"]), "k", "id") == [(1, 1), (2, 4)]
    assert rows(I.survivors(df, "k", [("s", "desc"), ("lvl", "asc")]), "k", "id") == [(1, 1), (2, 4)]


def test_survivor_by_latest_timestamp(spark):
    df = spark.createDataFrame([(1, 1, datetime(2024, 3, 10, 2, 30)), (2, 1, datetime(2024, 3, 10, 3, 30)),
                                (3, 2, datetime(1969, 12, 31, 23, 0)), (4, 2, None)],
                               "id bigint, k bigint, t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        s = rows(I.survivors(df, "k", [("t", "desc"), "id"]), "k", "id")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert s == [(1, 2), (2, 3)]
