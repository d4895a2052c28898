"""K1-K11 and N1-N8, including the hazards H3, H4, H6, H7, H16."""

import pytest
from pyspark.sql import functions as F

from shardfold.functions.columns import digits_of, make_guid, zone_of_guid
from shardfold.model import Tenant
from shardfold.operators import keys as K
from shardfold.operators import names as N
from helpers import rows


@pytest.fixture
def f1(spark):
    """Fixture F1: game core with an FK group and embedded id lists."""
    def tenant(name, zone, base):
        players = spark.createDataFrame(
            [(1, "p1", "acc1", 1, base, 10, "2"), (2, "p2", "acc2", None, base, 20, "1,12"),
             (0, "zero", "acc0", 0, base, 1, None), (-1, "neg", "accn", 1, base, 5, ""),
             (12, "same", "acc12", 1, base, 30, "1")],
            "dbid bigint, name string, account string, guildid bigint, serverid int, level int, friend_data string")
        roles = spark.createDataFrame([(1, 1), (2, 2), (3, 12)], "dbid bigint, playerid bigint")
        items = spark.createDataFrame([(5, 1), (6, 0), (7, None)], "dbid bigint, playerid bigint")
        guild = spark.createDataFrame([(1, "g" + name, base, "1,2")], "dbid bigint, name string, serverid int, players string")
        return Tenant(name, zone, {"players": players, "roles": roles, "items": items, "guild": guild},
                      {"players": "dbid", "roles": "dbid", "items": "dbid", "guild": "dbid"})
    return tenant("main", 1, 1), tenant("sub", 2, 2)


def test_max_ids_missing_table_counts_zero(f1):
    main, sub = f1
    got = K.max_ids([main, sub], [("players", "dbid"), ("nope", "x"), ("roles", "nope")])
    assert got == {("players", "dbid"): 12, ("nope", "x"): 0, ("roles", "nope"): 0}


def test_shift_keeps_zero_negative_null(spark):
    df = spark.createDataFrame([(5,), (0,), (-3,), (None,)], "k bigint")
    assert rows(K.shift(df, "k", 100)) == [(-3,), (0,), (105,), (None,)]
    assert K.shift(df, "k", 0) is df


def test_group_shift_keeps_fk_integrity(f1):
    main, sub = f1
    grp = [("players", "dbid"), ("roles", "playerid"), ("items", "playerid")]
    off = K.group_offset(main, sub, grp)
    assert off == 12
    s2 = K.shift_group(sub, grp, off)
    before = rows(sub.table("roles").alias("r").join(sub.table("players").alias("p"),
                                                   F.col("r.playerid") == F.col("p.dbid")), "name")
    after = rows(s2.table("roles").alias("r").join(s2.table("players").alias("p"),
                                                   F.col("r.playerid") == F.col("p.dbid")), "name")
    assert before == after
    # positive sub ids no longer overlap main's
    pm = {r.dbid for r in main.table("players").collect() if r.dbid > 0}
    ps = {r.dbid for r in s2.table("players").collect() if r.dbid > 0}
    assert not pm & ps


def test_shift_each(f1):
    main, sub = f1
    s2, offs = K.shift_each(main, sub, [("roles", "dbid"), ("items", "dbid")])
    assert offs == {("roles", "dbid"): 3, ("items", "dbid"): 7}
    assert rows(s2.table("items"), "dbid") == [(12,), (13,), (14,)]


def test_dense_ids_many_partitions(spark):
    ids = spark.range(0, 5000, 7).select((F.col("id") * 3 - 100).alias("x")).union(
        spark.createDataFrame([(None,), (-100,)], "x bigint"))
    m = K.dense_ids(ids, "x", partitions=5)
    got = dict((r.x, r.new_id) for r in m.collect())
    expected = {v: i + 1 for i, v in enumerate(sorted({r.x for r in ids.collect() if r.x is not None}))}
    assert got == expected


def test_dense_ids_many_equals_separate(spark):
    a = spark.createDataFrame([(5,), (9,), (5,), (None,)], "x bigint")
    b = spark.createDataFrame([(100,), (2,)], "x bigint")
    e = spark.createDataFrame([], "x bigint")
    got = [rows(m) for m in K.dense_ids_many([a, e, b], "x", partitions=3)]
    assert got == [[(5, 1), (9, 2)], [], [(2, 1), (100, 2)]]


def test_renumber_applies_to_every_member_with_condition(spark):
    guild = spark.createDataFrame([(100,), (40,), (7000,)], "ID bigint")
    member = spark.createDataFrame([(1, 40), (2, 7000), (3, 5)], "RoleID bigint, GuildID bigint")
    item = spark.createDataFrame([(1, 4294967295, 40), (2, 9, 100)], "SerialNum bigint, OwnerID bigint, AccountID bigint")
    t = Tenant("t", 1, {"guild": guild, "guild_member": member, "item": item})
    out = K.renumber(t, [("guild", "ID"), ("guild_member", "GuildID"),
                         ("item", "AccountID", " AND OwnerID = 4294967295 AND AccountID != 4294967295")])
    assert rows(out.table("guild")) == [(1,), (2,), (3,)]
    assert rows(out.table("guild_member")) == [(1, 1), (2, 3), (3, 5)]  # orphan 5 untouched
    assert rows(out.table("item")) == [(1, 4294967295, 1), (2, 9, 100)]


def test_shift_when_polymorphic(spark):
    item = spark.createDataFrame([(1, 10, 1), (2, 10, 2), (3, None, 1)], "id bigint, owner bigint, kind int")
    out = K.shift_when(item, "owner", 100, "WHERE kind = 1")
    assert rows(out, "id", "owner") == [(1, 110), (2, 10), (3, None)]


def test_shift_tokens_is_token_wise(spark):
    df = spark.createDataFrame([("1,12",), ("",), (None,), ("0,-1,x,3",)], "f string")
    out = K.shift_tokens(df, "f", 10)
    assert rows(out) == [("",), ("0,-1,x,13",), ("11,22",), (None,)]  # H6: never 11,112


def test_shift_tokens_valid_ids_only(f1):
    main, sub = f1
    p = sub.table("players")
    out = K.shift_tokens(p, "friend_data", 100, ",", valid_ids=spark_ids(p))
    got = dict((r.dbid, r.friend_data) for r in out.collect())
    assert got[2] == "101,112" and got[1] == "102" and got[0] is None and got[-1] == ""
    other = p.sparkSession.createDataFrame([(12,)], "id bigint")
    got = dict((r.dbid, r.friend_data) for r in K.shift_tokens(p, "friend_data", 100, ",", other).collect())
    assert got[2] == "1,112"


def spark_ids(df):
    return df.select("dbid")


def test_shift_associated_once(spark):
    """user_role.id in deal_with and primary_key; character.characterid is its own associated name (H4)."""
    def t(name, base):
        return Tenant(name, 1, {
            "character": spark.createDataFrame([(base + 1, 1), (base + 2, 1)], "characterid bigint, serverid int"),
            "bag": spark.createDataFrame([(1, base + 1), (2, base + 2)], "autoid bigint, characterid bigint"),
            "user_role": spark.createDataFrame([(base + 1, 1)], "id bigint, server_id int"),
            "email_item": spark.createDataFrame([(1, 1, base + 1)], "id bigint, email_id bigint, user_role_id bigint"),
        })
    main, sub = t("m", 10), t("s", 0)
    s2, plan = K.shift_associated(main, sub, [
        {"db_table": "character", "db_field": "characterid", "associated": "characterid"},
        {"db_table": "user_role", "db_field": "id", "associated": "user_role_id"}])
    assert rows(s2.table("character"), "characterid") == [(13,), (14,)]  # shifted once, not twice
    assert rows(s2.table("bag"), "characterid") == [(13,), (14,)]
    s3, offs = K.shift_by_column_name(main, s2, ["id", "autoid"], done=plan)
    assert ("user_role", "id") not in offs and ("email_item", "id") in offs
    assert rows(s3.table("user_role"), "id") == [(12,)]
    assert rows(s3.table("bag"), "autoid") == [(3,), (4,)]


def test_guid_zone_roundtrip(spark):
    df = spark.createDataFrame([(1, 5), (1023, 123456789)], "zone int, local bigint")
    out = df.select(zone_of_guid(make_guid("zone", "local")).alias("z"))
    assert rows(out) == [(1,), (1023,)]
    names = spark.createDataFrame([("game_s12",), ("none",)], "n string")
    assert rows(names.select(digits_of("n").alias("d"))) == [(-1,), (12,)]


def test_affix_modes(spark):
    df = spark.createDataFrame([("bob",), ("x",), (None,), ("a_s",)], "n string")
    assert rows(N.affix(df, "n", "S1.", "prefix", skip="x")) == [("S1.a_s",), ("S1.bob",), ("x",), (None,)]
    # literal suffix: "_" is not a wildcard
    assert rows(N.affix(df, "n", "_s", "suffix", idempotent=True)) == [("a_s",), ("bob_s",), ("x_s",), (None,)]
    assert rows(N.affix(df.where("n = 'bob'"), "n", "", "prefix")) == [("bob",)]
    assert rows(N.tenant_prefix(df.where("n = 'bob'"), "n", 7)) == [("s7bob",)]


def test_affix_conflicts_only_main_names(spark):
    sub = spark.createDataFrame([("bob",), ("amy",), ("",), (None,)], "n string")
    main = spark.createDataFrame([("bob",), ("",), ("Amy",)], "n string")
    out = N.affix_conflicts(sub, main, "n", "2s", "prefix", skip="")
    assert rows(out) == [("",), ("2sbob",), ("amy",), (None,)]  # binary compare: Amy != amy (H16)


def test_rename_duplicates_and_cascade(spark):
    p = spark.createDataFrame([(1, "ann", 1), (2, "ann", 2), (3, "bo", 2), (4, "bo", 3), (0, "bo", 2), (5, "cy", 2)],
                              "guid bigint, name string, zoneid int")
    renamed, renames = N.rename_duplicates(p, "name", "zoneid", 1, id_col="guid")
    assert rows(renamed) == [(0, "bo", 2), (1, "ann", 1), (2, "s2.ann", 2), (3, "s2.bo", 2), (4, "s3.bo", 3), (5, "cy", 2)]
    assert rows(renames, "id", "new_name") == [(2, "s2.ann"), (3, "s2.bo"), (4, "s3.bo")]
    members = spark.createDataFrame([(2, 7, "ann", 13), (3, 7, "bo", 1), (9, 8, "zed", 13)],
                                    "guid bigint, guildid bigint, name string, post int")
    assert rows(N.cascade(members, "guid", "name", renames), "guid", "name") == [(2, "s2.ann"), (3, "s2.bo"), (9, "zed")]
    ledger = N.rename_ledger(renames, 1)
    assert ledger.columns == ["guid", "name", "type"] and ledger.count() == 3


def test_guild_rename_and_ledger(spark):
    g = spark.createDataFrame([(1, "red"), (2, "red"), (3, "blue")], "local bigint, name string")
    guilds = g.select(make_guid(F.when(F.col("local") == 1, 1).otherwise(2), "local").alias("guid"), "name")
    renamed, renames = N.rename_guilds(guilds)
    assert sorted(r.name for r in renamed.collect()) == ["blue", "red", "s2.red"]
    gid = [r.guid for r in guilds.collect() if r.name == "red" and r.guid >> 54 == 2][0]
    members = spark.createDataFrame([(50, gid, 13, "boss"), (51, gid, 13, "vice"), (52, gid, 2, "x")],
                                    "guid bigint, guildid bigint, post int, name string")
    led = N.guild_ledger(renames, members)
    assert rows(led) == [(50, "boss", 2)]
    assert N.guild_ledger(renames, members.where("post <> 13")).count() == 0
