"""Several sources merge as they would one by one, and their plans grow with the sources alone."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from shardfold.model import Tenant
from shardfold.operators import identity as I
from shardfold.operators import keys as K
from shardfold.operators import merge as M
from shardfold.operators import names as N
from shardfold.plans import jobs as J
from shardfold.plans.reconcile import ACCOUNT_FOLDS, reconcile
from shardfold.session import ensure_checkpoint_dir

SOURCES = [
    [(1, 1, "m"), (1, 5, "m2"), (2, 2, "m"), (None, 9, "mn")],
    [(1, 7, "a"), (3, 3, "a"), (3, 4, "a2"), (None, 9, "an"), (None, 2, "an2")],
    [(3, 7, "b"), (4, None, "b"), (4, 8, "b2"), (2, 8, "b3")],
]


@pytest.mark.parametrize("keys", [["k"], [["k", "u"]], [["k"], ["u"]], []])
@pytest.mark.parametrize("first_wins", [False, True])
def test_together_equals_one_by_one(spark, keys, first_wins):
    frames = [spark.createDataFrame(r, "k int, u int, v string") for r in SOURCES]
    for n, order in ((2, (0, 1)), (3, (0, 1, 2)), (3, (0, 2, 1))):
        some = [frames[k] for k in order][:n]
        acc = some[0]
        for f in some[1:]:
            acc = M.merge_absent(acc, f, keys) if first_wins else M.merge_replace(acc, f, keys)
        assert rows(M.merge_all_table(some, keys, first_wins=first_wins)) == rows(acc)


@pytest.mark.parametrize("first_wins", [False, True])
def test_several_keys_equal_the_fold_on_random_sources(spark, first_wins):
    """Chains of blocked rows, NULL keys, a column in two key sets, repeated rows; draws of up to five sources."""
    rnd = random.Random(11)
    for draw in range(8):
        sources, keys = rnd.randint(2, 5), rnd.choice([[["k"], ["u"]], [["k"], ["u"], ["k", "w"]], [["k", "u"], ["u", "w"]]])
        span = rnd.choice([4, 12, 40])
        data = [[tuple(rnd.choice([None, *range(span)]) for _ in range(3)) + (f"{i}.{j}",) for j in range(rnd.randint(0, 12))] for i in range(sources)]
        data = [d + d[:1] for d in data]
        frames = [spark.createDataFrame(d, "k int, u int, w int, v string").coalesce(1) for d in data]
        acc = []
        for d in data:
            keyed = lambda r: [(i, tuple(r["kuw".index(c)] for c in ks)) for i, ks in enumerate(keys) if None not in [r["kuw".index(c)] for c in ks]]
            if first_wins:
                there = {x for r in acc for x in keyed(r)}
                acc = acc + [r for r in d if not there & set(keyed(r))]
            else:
                there = {x for r in d for x in keyed(r)}
                acc = [r for r in acc if not there & set(keyed(r))] + d
        assert sorted(map(str, acc)) == sorted(str(tuple(r)) for r in M.merge_all_table(frames, keys, first_wins=first_wins).collect()), (draw, keys)


def test_a_chain_of_blocked_rows(spark):
    """Each source shares a key with the one before it alone, so every second one gets in."""
    frames = [spark.createDataFrame([((i + 1) // 2, i // 2, str(i))], "k int, u int, v string") for i in range(7)]
    assert sorted(r.v for r in M.merge_absent_all(frames[0], frames[1:], [["k"], ["u"]]).collect()) == ["0", "2", "4", "6"]


def test_shuffles_of_several_keys_do_not_grow(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = lambda k: spark.range(k, 200, 3).select("id", (F.col("id") % 40).alias("u"), F.lit(k).alias("v"))
        n, scans = {}, {}
        for subs in (1, 2, 4, 8):
            out = M.merge_all_table([source(k) for k in range(subs + 1)], [["id"], ["u"]])
            plan = out._jdf.queryExecution().executedPlan().toString()
            n[subs], scans[subs] = plan.count("Exchange hashpartitioning"), plan.count("Range (")
        assert len(set(n.values())) == 1 and n[8] <= 6
        assert scans[8] == 9 * scans[1] // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rule_job_has_one_merge_per_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rules = {"type": "1", "other_identity": [{"db_table": "t", "db_field": "k"}]}
        def tenant(k):
            return Tenant(f"s{k}", k, {"t": spark.range(1, 50).select(F.col("id").alias("k"), F.lit(k).alias("v"))}, {"t": "k"})
        n = {}
        for subs in (2, 4, 8):
            out = J.run_rules(tenant(0), [J.SubTenant(tenant(k)) for k in range(1, subs + 1)], rules).main.table("t")
            n[subs] = shuffles(out)
            assert out.count() == out.select("k").distinct().count() == 49 * (subs + 1)
        assert n[2] == n[4] == n[8] <= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_with_maps_and_nan_are_ordered(spark):
    df = spark.createDataFrame([(1, 1.0, {"a": 1}), (1, float("nan"), {"a": 2}), (1, None, {"a": 3}), (2, 1.0, {"b": 1}), (2, 1.0, {"a": 1})],
                               "k int, x double, m map<string,int>")
    got = {r.k: r.m for r in I.survivors(df, "k", [("x", "desc")]).collect()}
    assert got == {1: {"a": 2}, 2: {"a": 1}}
    assert {r.k: r.m for r in M.last_per_key(df, ["k"], "x").collect()}[1] == {"a": 2}


def test_one_key_on_half_of_the_rows_is_spread(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    first = K.number_rows(df, ["k"], partitions=4)
    assert max(r.n for r in first.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 900
    again = K.number_rows(df.repartition(7), ["k"], partitions=4)
    assert rows(first) == rows(again)


def test_names_without_case(spark):
    df = spark.createDataFrame([(1, "Ann", 1), (2, "ann", 2), (3, None, 2), (4, "", 2), (5, "bob", 2)], "id bigint, name string, zone int")
    out, _ = N.rename_duplicates(df, "name", "zone", 1, id_col="id", case_insensitive=True)
    assert rows(out, "id", "name") == [(1, "Ann"), (2, "s2.ann"), (3, None), (4, ""), (5, "bob")]
    out, _ = N.rename_duplicates(df, "name", "zone", 1, id_col="id")
    assert rows(out, "id", "name") == rows(df, "id", "name")
    got = N.affix_conflicts(df.where("zone = 2"), df.where("zone = 1"), "name", "_2", "suffix", case_insensitive=True)
    assert rows(got, "id", "name") == [(2, "ann_2"), (3, None), (4, ""), (5, "bob")]


def game(spark, zone, accounts, extra=()):
    cols = "guid bigint, accid bigint, " + ", ".join(f"{c} bigint" for c in ACCOUNT_FOLDS)
    t = {"t_account": spark.createDataFrame(accounts, cols)}
    return Tenant(f"z{zone}", zone, t | dict(extra), {"t_account": "guid"})


def test_reconcile_folds_every_column_and_keeps_main(spark):
    n = len(ACCOUNT_FOLDS)
    ledger = spark.createDataFrame([(7, None, "old", 1)], "guid bigint, accid bigint, name string, type int")
    names = lambda *x: spark.createDataFrame(x, "name string, v int")
    odd = lambda *x: spark.createDataFrame(x, "guid bigint, v int")
    statue = lambda guid: spark.createDataFrame([(guid, 9)], "guid bigint, statuetype int")
    player = lambda *x: spark.createDataFrame(x, "guid bigint, name string, zoneid int")
    main = game(spark, 1, [(1, 9, *[5] * n)], {"t_merge_give_namecard": ledger, "t_figure_statue": statue(1), "t_player_info_name": names(("m", 1), ("m", 2)),
                                               "t_abnormal_transaction": odd((4, 1)), "t_player_info": player((1, "dup", 1))})
    subs = [game(spark, z, [(z, 9, *[150] * n)], {"t_figure_statue": statue(2), "t_player_info_name": names(("b", z), ("b", z + 10), ("m", 3)),
                                                  "t_abnormal_transaction": odd((4, z)), "t_only_sub": odd((1, 1)), "t_player_info": player((z, "dup", z))}) for z in (2, 3)]
    res = reconcile(main, subs)
    got = res.main.table("t_account").first().asDict()
    want = {"sum": 305, "min": 5, "max": 150}
    assert {c: got[c] for c in ACCOUNT_FOLDS} == {c: 200 if isinstance(k, tuple) else want[k] for c, k in ACCOUNT_FOLDS.items()}
    assert rows(res.main.table("t_figure_statue")) == [(1, 9)]
    assert rows(res.main.table("t_player_info_name")) == [("b", 2), ("b", 12), ("m", 1), ("m", 2)]
    assert rows(res.main.table("t_abnormal_transaction")) == [(4, 1), (5, 2), (6, 3)]
    assert rows(res.main.table("t_merge_give_namecard"), "guid", "name") == [(2, "s2.dup"), (3, "s3.dup"), (7, "old")]
    told = set(res.actions)
    assert ("z2", "t_figure_statue", "not listed") in told and ("z3", "t_only_sub", "not listed") in told and ("z2", "t_account", "appended") in told
    less = reconcile(Tenant("m", 1, {"t_account": main.table("t_account").drop("point")}, {"t_account": "guid"}), [])
    assert ("m", "t_account", "no column point") in less.actions


def test_type3_widens_before_it_shifts(spark):
    ids = lambda x: {"c": spark.createDataFrame([(x,)], T.StructType([T.StructField("id", T.IntegerType())]))}
    main, sub = Tenant("m", 1, ids(1_500_000_000)), Tenant("s", 2, ids(1_400_000_000))
    for sp in ({"deal_with": [{"db_table": "c", "db_field": "id", "associated": "id"}]}, {"primary_key": [{"db_field": "id"}]}):
        rules = {"type": "3", "simple_process": {"character_types": "1", **sp}}
        assert rows(J.run_rules(main, [J.SubTenant(sub)], rules).main.table("c")) == [(1_500_000_000,), (2_900_000_000,)]


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"
        def getCheckpointDir(self):
            return None
    class Session:
        sparkContext = Context()
        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_orders_of_sources_are_all_used(spark):
    for order in itertools.permutations(range(3)):
        frames = [spark.createDataFrame(SOURCES[k], "k int, u int, v string") for k in order]
        last = {r.k: r.v for r in M.merge_all_table(frames, ["k"]).where("k IS NOT NULL").orderBy("v").collect()}
        assert all(any(r[0] == k for r in SOURCES[order[-1]]) or v not in [r[2] for r in SOURCES[order[-1]]] for k, v in last.items())
