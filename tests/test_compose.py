"""Composed renumberings equal the step-by-step job; ids in texts follow; frequent keys are split."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shardfold.model import Tenant
from shardfold.operators import identity as I
from shardfold.operators import keys as K
from shardfold.operators import lookup as L
from shardfold.operators import names as N
from shardfold.plans import compose
from shardfold.plans import jobs as J

RULES = {
    "type": "2", "restructure_state": "1",
    "restructure_tool": [{"group": [{"db_table": "p", "db_field": "id"}, {"db_table": "r", "db_field": "pid", "conditions": "kind = 1"}]},
                         {"group": [{"db_table": "g", "db_field": "gid"}, {"db_table": "p", "db_field": "gid"}]}],
    "same": [{"group": [{"db_table": "p", "db_field": "id"}, {"db_table": "r", "db_field": "pid"}]}],
    "other_identity": [{"db_table": "r", "db_field": "rid"}],
    "special_option": {"teshudb_field_open": "1", "teshudb_field": [
        {"db_table": "r", "db_field": "friends", "db_table_attribution": "p", "db_field_attribution": "id", "group": "1", "type": "1"}]},
    "prefix_setting": {"role_is": "1", "repeat_modify": "1", "additional_string": "1", "prefix": "x.", "role_name": [{"db_table": "p", "db_field": "name"}]},
}


def tenant(spark, k, rnd, n):
    ids = rnd.sample(range(1, 60), n)
    gids = rnd.sample(range(1, 30), 4)
    p = [(i, rnd.choice(gids + [77, 0]), rnd.choice("abcdefgh") * 2) for i in ids]
    r = [(i, rnd.choice(ids + [0, 3, 41, 500]), rnd.choice([1, 2]), ",".join(str(rnd.choice(ids + [5, 17, 999, -1, "x"])) for _ in range(rnd.randint(0, 4)))) for i in rnd.sample(range(1, 90), 8)]
    return Tenant(f"t{k}", k, {"p": spark.createDataFrame(p, "id bigint, gid bigint, name string").coalesce(1),
                               "r": spark.createDataFrame(r, "rid bigint, pid bigint, kind int, friends string").coalesce(1),
                               "g": spark.createDataFrame([(x, f"{k}.{x}") for x in gids], "gid bigint, gname string").coalesce(1),
                               "quiet": spark.createDataFrame([(k,)], "v int")}, {"p": "id", "r": "rid", "g": "gid"})


@pytest.mark.parametrize("sizes", [(3, 9, 5)])
def test_composed_equals_step_by_step(spark, sizes, monkeypatch):
    rnd = random.Random(sum(sizes))
    ten = [tenant(spark, k + 1, rnd, n) for k, n in enumerate(sizes)]
    subs = [J.SubTenant(t) for t in ten[1:]]
    want = J.run_rules(ten[0], subs, RULES, checkpoint_between=True).main
    copied = []
    monkeypatch.setattr(J, "cut_lineage", lambda df, real=J.cut_lineage: copied.append(df.columns) or real(df))
    got = J.run_rules(ten[0], subs, RULES).main
    assert all(len(c) == 1 for c in copied)  # names alone, never a table
    for t in ("p", "r", "g", "quiet"):
        assert rows(got.table(t)) == rows(want.table(t)), t


def test_only_groups_that_can_be_followed_are_composed(spark):
    ten = tenant(spark, 1, random.Random(1), 3)
    ok = lambda rules, t=ten, known=(): compose.composable(rules, t, [], known)
    group = lambda *m: {**RULES, "restructure_tool": [{"group": [dict(zip(("db_table", "db_field", "conditions"), x)) for x in m]}]}
    assert ok(RULES) and ok(group(("p", "id")), known=[("r", "rid"), ("p", "id")])
    assert not ok(group(("p", "id", "gid > 0"))) and not ok(group(("r", "pid"), ("p", "id"))) and not ok(group(("g", "gid"), ("p", "id")))
    assert not ok(group(("p", "id"), ("r", "pid")), known=[("r", "pid")]) and not ok(group(("p", "id")), known=[("p", "gid")])
    assert not ok(RULES, ten.with_specs({"p": [["id"], ["name"]]}))


def test_functions_are_put_together(spark):
    f = spark.createDataFrame([(5, 1), (9, 2)], "old bigint, new_id bigint")
    g = spark.createDataFrame([(2, 7), (9, 8)], "old bigint, new_id bigint")
    assert rows(compose.then(f, g)) == [(2, 7), (5, 1), (9, 7)] and rows(compose.then(g, f)) == [(2, 7), (5, 1), (9, 8)]
    assert compose.then(None, None) is None and compose.then(f, None) is f and compose.then(None, g) is g


def test_a_table_that_is_not_renumbered_is_not_copied(spark, monkeypatch):
    ten = [tenant(spark, k, random.Random(k), 4) for k in (1, 2, 3)]
    ten = [t.with_tables({f"log{j}": spark.createDataFrame([(t.zone, j)], "z int, j int") for j in range(5)}) for t in ten]
    rules = {k: v for k, v in RULES.items() if k != "prefix_setting"}
    n = []
    monkeypatch.setattr(J, "cut_lineage", lambda df, real=J.cut_lineage: n.append(1) or real(df))
    J.run_rules(ten[0], [J.SubTenant(t) for t in ten[1:]], rules)
    assert not n


def largest_share(df):
    parts = [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(parts) / sum(parts)


@pytest.fixture()
def no_help(spark):
    """Neither broadcasts nor skew joins by Spark itself."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_half_of_the_rows_on_one_id_are_spread(spark, no_help):
    child = spark.range(8000).select("id", F.when(F.col("id") % 4 < 2, 0).when(F.col("id") % 4 == 2, F.lit(None)).otherwise(F.col("id") % 100).alias("fk"),
                                     F.when(F.col("id") % 2 == 0, "common").otherwise(F.concat(F.lit("n"), "id")).alias("name")).repartition(8)
    ids = spark.range(1, 101).select(F.col("id").alias("old"), (F.col("id") + 1000).alias("new_id"))
    out = K.apply_mapping(child, "fk", ids)
    want = [(r.id, r.fk + 1000 if r.fk else r.fk) for r in child.collect()]
    assert rows(out, "id", "fk") == sorted(want) and largest_share(out) < 0.25
    keep = ids.union(spark.createDataFrame([(0, 7)], "old bigint, new_id bigint"))
    out = I.repoint(child, "fk", "fk", keep, "old", "new_id")
    assert largest_share(out) < 0.25 and out.where("fk = 7").count() == 4000
    renames = ids.select(F.col("old").alias("id"), F.lit("new").alias("new_name")).union(spark.createDataFrame([(0, "zero")], "id bigint, new_name string"))
    out = N.cascade(child, "fk", "name", renames)
    assert largest_share(out) < 0.25 and out.where("name = 'zero'").count() == 4000
    out = N.affix_conflicts(child, spark.createDataFrame([("common",), ("n1",)], "name string"), "name", "x.")
    assert largest_share(out) < 0.25 and out.where("name = 'x.common'").count() == 4000 and out.where("name = 'x.n1'").count() == 1


def test_repeated_rows_without_another_column_are_spread(spark, no_help):
    child = spark.range(0, 8000, 1, 8).select((F.col("id") % 2 * 0).alias("fk"))
    out = L.lookup(child, "fk", spark.createDataFrame([(1, "a")], "k bigint, v string"), "k", {"v": "v"})
    assert out.count() == 8000 and largest_share(out) <= 0.5
    with_map = spark.createDataFrame([(1, {"a": 1}), (None, None)], "fk bigint, m map<string,int>")
    assert {r.fk: r.v for r in L.lookup(with_map, "fk", spark.createDataFrame([(1, "a")], "k bigint, v string"), "k", {"v": "v"}).collect()} == {1: "a", None: None}


def test_ids_in_texts_follow_a_mapping(spark, no_help):
    df = spark.createDataFrame([(1, "5,7,x,-5,, 5"), (2, None), (3, ""), (4, "7,7,70"), (4, "5")], "id int, t string")
    m = spark.createDataFrame([(5, 50), (7, 5)], "old bigint, new_id bigint")
    assert sorted((r.id, r.t) for r in K.map_tokens(df, "t", m).collect() if r.t is not None) == [(1, "50,5,x,-5,,50"), (3, ""), (4, "5,5,70"), (4, "50")]
    one = df.where("id < 4")
    assert rows(K.map_tokens(one, "t", m, row_key="id")) == rows(K.map_tokens(one, "t", m))
