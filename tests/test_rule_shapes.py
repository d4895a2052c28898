"""

Each shape gives the rule type, the sizes of its ``same`` groups, the number
of ``other_identity`` columns and excluded tables, and its features.  A
synthetic main and sub are generated for the shape, the rules run end to end
(:func:`run_rules`), and invariants are checked on the merged result:
foreign keys still resolve, positive ids of a group no longer collide,
excluded tables keep main's rows only.
"""

import pytest

from shardfold.model import Tenant
from shardfold.plans.jobs import SubTenant, run_rules

#: (name, type, same group sizes, other count, excluded count, features)
SHAPES = [
    ("dcsg", 2, [], 2, 17, {"stamp": 1}),
    ("djws", 2, [38, 2, 2], 8, 21, {"special": 2, "modify": 1, "acct1": 1}),
    ("dslh", 2, [3, 2], 2, 17, {"teshudb": 2, "conflict_prefix": 1}),
    ("gcld", 2, [3, 83, 2], 38, 29, {"acct1": 1, "skip_name": "general"}),
    ("gcldnew", 2, [3, 83, 2], 38, 29, {"acct999": 2}),
    ("gmzr", 2, [], 22, 52, {"acct999": 0}),
    ("jyjy", 2, [80, 2, 2], 32, 2, {"teshudb": 1}),
    ("jyjys", 3, [], 0, 2, {"deal_with": 3, "primary_key": 1}),
    ("longol", 2, [4, 27, 3, 2, 5], 2, 25, {"restructure": 1, "special": 8, "widen": 1, "acct1": 1}),
    ("mhj", 3, [], 0, 54, {"deal_with": 2, "primary_key": 2, "widen": 1}),
    ("myjx", 2, [], 1, 7, {}),
    ("nsxy", 2, [], 2, 17, {"stamp": 1}),
    ("syz", 1, [], 8, 55, {"suffix": 1, "stamp": 3, "acct1": 1}),
    ("txxt", 2, [], 20, 30, {"skip_name": "\0"}),
    ("tydl", 2, [2], 1, 14, {"acct999": 1, "stamp": 2}),
    ("wszw", 2, [], 27, 31, {"skip_name": "\0"}),
    ("xhtsgs", 2, [5], 15, 52, {"suffix": 1, "stamp": 1, "acct1": 2}),
    ("xkx", 2, [2, 84, 6], 78, 33, {"names": 5, "acct999": 1}),
    ("xlhj", 2, [], 0, 3, {"names": 1}),
    ("ylcq", 2, [18, 5], 0, 28, {"suffix": 1, "stamp": 2}),
    ("ymcq", 1, [], 0, 5, {"stamp": 8}),
    ("ymz", 2, [], 25, 30, {"skip_name": "\0"}),
    ("zsg", 2, [6], 2, 25, {"acct1": 3}),
]


def build(spark, shape, zone):
    name, kind, groups, n_other, n_ex, feat = shape
    t, specs = {}, {}
    ids = [1, 2, 3] if zone == 1 else [1, 2, 4]

    def add(tb, rows_, schema, key=None):
        t[tb] = spark.createDataFrame(rows_, schema)
        if key:
            specs[tb] = key
    for g, size in enumerate(groups):
        add(f"g{g}_p", [(i, f"n{i}" if i != 2 else "general", zone, ",".join(str(j) for j in ids if j != i))
                        for i in ids], "id bigint, name string, serverid int, friends string", "id")
        for j in range(1, size):
            add(f"g{g}_c{j}", [(10 * zone + k, ids[k % 3]) for k in range(3)], "cid bigint, ref bigint", "cid")
    for i in range(n_other):
        add(f"o{i}", [(i_, zone) for i_ in ids], "id bigint, serverid int", "id")
    for i in range(n_ex):
        add(f"x{i}", [(zone,)], "id bigint")
    if feat.get("special") or feat.get("restructure"):
        add("poly", [(1, 1, 1), (2, 2, 2), (3, 4294967295, 1)], "pid bigint, owner bigint, kind int", "pid")
    if feat.get("restructure"):
        add("guildx", [(100 * zone + 7,), (100 * zone + 3,)], "gid bigint", "gid")
        add("guildx_m", [(100 * zone + 7, 1), (4294967295, 2)], "gref bigint, mid bigint", "mid")
    if feat.get("modify"):
        add("flags", [(1, 1), (2, 0)], "id bigint, opened int", "id")
    if feat.get("acct1") or "acct999" in feat:
        add("acct", [(1, "bob"), (2, f"u{zone}")], "id bigint, username string", "id")
        add("member", [(1, 1), (2, 2)], "mid bigint, acct_id bigint", "mid")
    if kind == 3:
        for i in range(feat.get("deal_with", 0)):
            add(f"d{i}", [(i_, zone) for i_ in ids], f"did{i} bigint, serverid int", f"did{i}")
            add(f"d{i}_use", [(50 * zone + k, ids[k]) for k in range(3)], f"uid bigint, did{i}ref bigint", "uid")
        for i in range(feat.get("primary_key", 0)):
            add(f"k{i}", [(j,) for j in ids], f"pk{i} bigint", f"pk{i}")
    return Tenant(f"{name}_{zone}", zone, t, specs)


def rules_for(shape):
    name, kind, groups, n_other, n_ex, feat = shape
    r = {"type": str(kind),
         "same": [{"group": [{"db_table": f"g{g}_p", "db_field": "id"}] +
                   [{"db_table": f"g{g}_c{j}", "db_field": "ref"} for j in range(1, size)]} for g, size in enumerate(groups)],
         "other_identity": [{"db_table": f"o{i}", "db_field": "id"} for i in range(n_other)],
         "un_merge": [{"db_table": f"x{i}"} for i in range(n_ex)]}
    names = [{"db_table": f"g{g}_p", "db_field": "name", "not_equal": feat.get("skip_name", "")}
             for g in range(len(groups))][: max(1, feat.get("names", 1))]
    r["prefix_setting"] = {"role_is": "1" if names else "0", "guild_is": "0", "prefix": "s2.",
                           "repeat_modify": "1" if feat.get("conflict_prefix") else "2",
                           "additional_string": "2" if feat.get("suffix") else "1", "role_name": names,
                           "account_change": "0", "account_suffix": "_s2"}
    if feat.get("acct1"):
        r["prefix_setting"].update(account_change="1",
                                   account_table=[{"db_table": "acct", "db_field": "username"}] * feat["acct1"])
    if "acct999" in feat:
        r["prefix_setting"].update(account_change="999", account_change_new=[
            {"db_table_user": "acct", "db_field_user_id": "id", "db_field_user_name": "username",
             "db_table_player": "member", "db_field_player_user_id": "acct_id"}] * feat["acct999"])
    if feat.get("stamp"):
        tables = [f"o{i}" for i in range(n_other)] + [f"g{g}_p" for g in range(len(groups))] + \
            [f"d{i}" for i in range(feat.get("deal_with", 0))]
        r["server_info"] = {"server_is": "1", "server_sql": [{"db_table": tb, "db_field": "serverid"}
                                                             for tb in (tables or ["nope"])][: feat["stamp"]]}
    opt = {}
    if feat.get("special") and (groups or n_other):
        opt.update(special_field_open="1", special_field=[
            {"db_table": "poly", "db_field": "owner", "group": "1" if groups else "2", "type": "1",
             "conditions": f"where kind = {1 + i % 2} AND owner != 4294967295"} for i in range(feat["special"])])
    if feat.get("teshudb"):
        opt.update(teshudb_field_open="1", teshudb_field=[
            {"db_table": "g0_p", "db_field": "friends", "group": "1", "type": "1",
             "db_table_attribution": "g0_p", "db_field_attribution": "id"}] * feat["teshudb"])
    r["special_option"] = opt
    if feat.get("restructure"):
        r["restructure_state"] = "1"
        r["restructure_tool"] = [{"group": [{"db_table": "guildx", "db_field": "gid", "conditions": ""},
                                            {"db_table": "guildx_m", "db_field": "gref",
                                             "conditions": " AND gref != 4294967295"}]}]
    if feat.get("modify"):
        r["modify_table"] = [{"db_table": "flags", "db_field": "opened", "results": "0", "conditions": "1"}]
    sp = {"character_types": "1" if feat.get("widen") else "0"}
    if kind == 3:
        sp["deal_with"] = [{"db_table": f"d{i}", "db_field": f"did{i}", "associated": f"did{i}ref"}
                           for i in range(feat.get("deal_with", 0))]
        sp["primary_key"] = [{"db_field": f"pk{i}"} for i in range(feat.get("primary_key", 0))]
    r["simple_process"] = sp
    return r


def ids_of(df, c):
    return [r[c] for r in df.select(c).collect()]


@pytest.mark.parametrize("shape", SHAPES, ids=[s[0] for s in SHAPES])
def test_rule_shape(spark, shape):
    name, kind, groups, n_other, n_ex, feat = shape
    main, sub = build(spark, shape, 1), build(spark, shape, 2)
    rules = rules_for(shape)
    acc = {"main_accounts": Tenant("am", 1, {"acct": main.table("acct")}, {"acct": "id"})} if feat.get("acct1") else {}
    subs = [SubTenant(sub, server_id=99, accounts=Tenant("as", 2, {"acct": sub.table("acct")}, {"acct": "id"})
                      if feat.get("acct1") else None)]
    res = run_rules(main, subs, rules, declared_tables=True, **acc)
    out = res.main
    for g, size in enumerate(groups):
        parents = ids_of(out.table(f"g{g}_p"), "id")
        assert len(parents) == len(set(parents)) == 6  # positive ids no longer collide: nothing replaced
        for j in range(1, min(size, 4)):
            assert set(ids_of(out.table(f"g{g}_c{j}"), "ref")) <= set(parents)
    for i in range(min(n_other, 3)):
        assert out.table(f"o{i}").count() == 6
    for i in range(min(n_ex, 2)):
        assert ids_of(out.table(f"x{i}"), "id") == [1]
    if kind == 3:
        for i in range(feat.get("deal_with", 0)):
            ds = ids_of(out.table(f"d{i}"), f"did{i}")
            assert len(set(ds)) == 6 and set(ids_of(out.table(f"d{i}_use"), f"did{i}ref")) <= set(ds)
    if feat.get("teshudb"):
        friends = {r.id: r.friends for r in out.table("g0_p").collect()}
        assert all(int(x) in friends for v in friends.values() for x in v.split(","))
    if feat.get("modify"):
        assert set(ids_of(out.table("flags"), "opened")) == {0}
    if feat.get("restructure"):
        # renumbered 1..n on both sides; guildx is in no "same" group here, so the sub's rows win on 1, 2
        assert sorted(ids_of(out.table("guildx"), "gid")) == [1, 2]
        assert sorted(ids_of(out.table("guildx_m"), "gref")) == [2, 4294967295]
