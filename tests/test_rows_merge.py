"""P1-P10 and M1-M8 on tiny inline tables (NULL, 0, negative, duplicate keys)."""

import pytest
from pyspark.sql import functions as F

from shardfold.model import Tenant
from shardfold.operators import merge as M
from shardfold.operators import rows as P
from helpers import rows


@pytest.fixture
def players(spark):
    return spark.createDataFrame(
        [(1, "a", 3, 10), (0, "zero", None, 5), (-1, "neg", 1, None), (2, None, 2, 7)],
        "dbid bigint, name string, guildid bigint, level int")


def test_set_const_and_where(players):
    out = P.set_const(players, {"level": 1})
    assert {r.level for r in out.collect()} == {1}
    assert dict(out.dtypes)["level"] == "int"
    out = P.set_where(players, "level > 6", {"name": "hi"})
    # NULL predicate (level NULL) keeps the row unchanged
    assert rows(out, "dbid", "name") == rows(players.withColumn(
        "name", F.when(F.col("level") > 6, "hi").otherwise(F.col("name"))), "dbid", "name")
    assert [r.name for r in out.where("dbid = -1").collect()] == ["neg"]


def test_map_values_in_order(players):
    out = P.map_values(players, "level", {10: 5, 5: 0})
    assert rows(out, "dbid", "level") == [(-1, None), (0, 0), (1, 0), (2, 7)]


def test_stamp_zone_widen(players):
    out = P.with_zone(P.stamp_tenant(players, ["guildid", "absent"], 9), 3)
    assert {r.guildid for r in out.collect()} == {9}
    assert dict(out.dtypes)["zone_id"] == "int"
    assert dict(P.widen(players, ["level"]).dtypes)["level"] == "bigint"


def test_delete_where_keeps_null(players):
    out = P.delete_where(players, "level > 6")
    assert sorted(r.dbid for r in out.collect()) == [-1, 0]


def test_empty_keeps_schema(players):
    e = P.empty(players)
    assert e.count() == 0 and e.schema == players.schema


def test_rule_chain_sees_previous(players):
    out = P.apply_rules(players, [("level", "level + 100", "level < 8"), ("level", 0, "level > 100")])
    assert rows(out, "dbid", "level") == [(-1, None), (0, 0), (1, 10), (2, 0)]


def test_filter_rows_text(players):
    assert P.filter_rows(players, "WHERE level >= 7").count() == 2


@pytest.fixture
def pair(spark):
    main = spark.createDataFrame([(1, "m1"), (2, "m2"), (None, "mnull"), (0, "m0")], "k bigint, v string")
    sub = spark.createDataFrame([(2, "s2"), (3, "s3"), (None, "snull"), (0, "s0")], "k bigint, v string")
    return main, sub


def test_replace_merge(pair):
    main, sub = pair
    out = M.merge_replace(main, sub, "k")
    # NULL keys never clash, 0 does (H3)
    assert rows(out) == rows(main.where("k = 1 OR k IS NULL").unionByName(sub))
    assert out.count() == main.count() - 2 + sub.count()


def test_replace_merge_duplicate_incoming(spark):
    main = spark.createDataFrame([(1, "m", 0)], "k bigint, v string, seq int")
    sub = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k bigint, v string, seq int")
    assert rows(M.merge_replace(main, sub, "k", order_by="seq"), "k", "v") == [(1, "new")]


def test_replace_multi_unique(spark):
    main = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k bigint, name string")
    sub = spark.createDataFrame([(9, "y"), (1, "q")], "k bigint, name string")
    out = M.merge_replace(main, sub, [["k"], ["name"]])
    assert rows(out) == [(1, "q"), (3, "z"), (9, "y")]


def test_append_conflict_and_modes(pair):
    main, sub = pair
    with pytest.raises(M.MergeConflict):
        M.merge_append(main, sub, "k")
    assert M.merge_append(main, sub.where("k = 3"), "k").count() == 5
    ign = M.merge_append(main, sub, "k", on_conflict="ignore")
    assert rows(ign, "k", "v") == rows(main.unionByName(sub.where("k = 3 OR k IS NULL")), "k", "v")


def test_append_all_one_check(spark):
    main = spark.createDataFrame([(1, "m"), (None, "mn")], "k bigint, v string")
    a = spark.createDataFrame([(2, "a"), (None, "an")], "k bigint, v string")
    b = spark.createDataFrame([(3, "b")], "k bigint, v string")
    assert rows(M.merge_append_all(main, [a, b], "k")) == [(1, "m"), (2, "a"), (3, "b"), (None, "an"), (None, "mn")]
    with pytest.raises(M.MergeConflict):
        M.merge_append_all(main, [a, b, spark.createDataFrame([(2, "c")], "k bigint, v string")], "k")
    with pytest.raises(M.MergeConflict):  # a key twice inside one sub fails too
        M.merge_append_all(main, [spark.createDataFrame([(7, "x"), (7, "y")], "k bigint, v string")], "k")


def test_align_by_name_and_missing(spark):
    main = spark.createDataFrame([(1, "a")], "k bigint, v string")
    sub = spark.createDataFrame([("b", 2)], "v string, k int")
    out = M.merge_replace(main, sub, "k")
    assert out.columns == ["k", "v"] and rows(out) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        M.merge_replace(main, sub.withColumn("extra", F.lit(1)), "k")
    short = spark.createDataFrame([(5,)], "k bigint")
    assert rows(M.merge_replace(main, short, "k", allow_missing=True)) == [(1, "a"), (5, None)]


def test_filtered_merge(pair):
    main, sub = pair
    out = M.merge_filtered(main, sub, "k", "v = 's3'")
    assert rows(out, "k", "v") == rows(main.unionByName(sub.where("v = 's3'")), "k", "v")


def test_append_new_surrogate_dirty_keys(spark):
    main = spark.createDataFrame([(4, "a")], "guid bigint, v string")
    sub = spark.createDataFrame([(2, "x"), (2, "y"), (None, "z"), (1, "w")], "guid bigint, v string")
    out = rows(M.append_new_surrogate(main, sub, "guid"))
    assert [g for g, _ in out] == [4, 5, 6, 7, 8]  # every row its own id
    assert dict((v, g) for g, v in out)["w"] == 5 and dict((v, g) for g, v in out)["z"] == 8


def test_append_new_surrogate(spark):
    main = spark.createDataFrame([(1, "a"), (7, "b")], "guid bigint, v string")
    sub = spark.createDataFrame([(1, "c"), (3, "d"), (2, "e")], "guid bigint, v string")
    out = M.append_new_surrogate(main, sub, "guid")
    assert \
        sorted(rows(out)) == sorted([(1, "a"), (7, "b"), (8, "c"), (9, "e"), (10, "d")])


def test_merge_tenant_actions(spark, pair):
    main_df, sub_df = pair
    main = Tenant("m", 1, {"t": main_df, "only_main": main_df, "ex": main_df}, {"t": "k"})
    sub = Tenant("s", 2, {"t": sub_df, "ex": sub_df, "new": sub_df}, {"t": "k"})
    merged, actions = M.merge_tenant(main, sub, exclude=["ex"])
    assert dict(actions) == {"t": "merged", "ex": "excluded", "new": "missing"}
    assert merged.table("ex") is main_df and not merged.has("new")
    merged, actions = M.merge_tenant(main, sub, exclude=["ex"], on_missing="copy")
    assert merged.table("new").count() == 4
    with pytest.raises(KeyError):
        M.merge_tenant(main, sub, on_missing="error")
    drift = sub.with_tables({"t": sub_df.withColumn("extra", F.lit(1))})
    merged, actions = M.merge_tenant(main, drift, exclude=["ex"], on_error="skip")
    assert dict(actions)["t"] == "failed" and merged.table("t") is main_df
    with pytest.raises(ValueError):
        M.merge_tenant(main, drift, exclude=["ex"])


def test_merge_all_last_wins(spark):
    a = spark.createDataFrame([(1, "a1"), (2, "a2"), (None, "an")], "k bigint, v string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3")], "k bigint, v string")
    c = spark.createDataFrame([(3, "c3"), (None, "cn")], "k bigint, v string")
    out = M.merge_all_table([a, b, c], "k")
    seq = M.merge_replace(M.merge_replace(a, b, "k"), c, "k")
    assert rows(out) == rows(seq)
    t = M.merge_all(Tenant("a", 1, {"t": a}, {"t": "k"}), [Tenant("b", 2, {"t": b}), Tenant("c", 3, {"t": c})])
    assert rows(t.table("t")) == rows(seq)


def test_absent_many_first_wins(spark):
    a = spark.createDataFrame([(1, "a1"), (2, "a2")], "k bigint, v string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3"), (None, "bn")], "k bigint, v string")
    c = spark.createDataFrame([(3, "c3"), (4, "c4")], "k bigint, v string")
    one = M.merge_all_table([a, b, c], "k", first_wins=True)
    seq = M.merge_absent(M.merge_absent(a, b, "k"), c, "k")
    assert rows(one) == rows(seq) == [(1, "a1"), (2, "a2"), (3, "b3"), (4, "c4"), (None, "bn")]


def test_merge_accounts(spark):
    main = Tenant("ma", 1, {"users": spark.createDataFrame([(1, "bob")], "id bigint, user_name string")},
                  {"users": "id"})
    sub = Tenant("sa", 2, {"users": spark.createDataFrame([(2, "amy"), (3, "joe_s2")], "id bigint, user_name string"),
                           "login": spark.createDataFrame([(2, "amy", "x")], "id bigint, account string, name string")},
                 {"users": "id"})
    main = main.with_tables({"login": spark.createDataFrame([(1, "bob", "y")], "id bigint, account string, name string")})
    out = M.merge_accounts(main, sub, "_s2")
    assert rows(out.table("users")) == [(1, "bob"), (2, "amy_s2"), (3, "joe_s2")]
    assert rows(out.table("login")) == [(1, "bob", "y"), (2, "amy_s2", "x")]  # every candidate table, first name column
    assert M.account_tables(sub) == [("users", "user_name"), ("login", "account")]
