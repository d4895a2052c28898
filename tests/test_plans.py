"""Plan-shape tests: the scale properties the design relies on, read from the physical plan."""

from pyspark.sql import functions as F

from shardfold.operators import identity as I
from shardfold.operators import keys as K
from shardfold.operators import merge as M
from shardfold.operators import names as N
from shardfold.plans import catalogue as C
from helpers import rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=3000):
    """A third of all rows on one key (user 0), the rest spread."""
    return spark.range(n).select(F.col("id").alias("event_id"),
                                 F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1).alias("user_id"),
                                 (F.col("id") % 13).cast("double").alias("value"),
                                 (F.col("id") % 3 + 1).cast("int").alias("zone"))


def test_survivor_and_fold_aggregate_partially(spark):
    e = hot(spark)
    for df in (I.survivors(e, "user_id", [("value", "desc"), "event_id"], prefer=F.col("zone") == 1),
               I.fold(e, "user_id", ["event_id"], {"value": "sum"})):
        p = plan(df)
        assert "Window" not in p and ("partial_min" in p or "partial_max" in p), p
    s = I.survivors(e, "user_id", [("value", "desc"), "event_id"], prefer=F.col("zone") == 1)
    assert [r.event_id for r in s.where("user_id = 0").collect()] == [12]  # zone 1 and the highest value


def test_rename_duplicates_no_window(spark):
    df = hot(spark).select("event_id", F.col("user_id").cast("string").alias("name"), "zone")
    renamed, renames = N.rename_duplicates(df, "name", "zone", 1, id_col="event_id")
    assert "Window" not in plan(renamed)
    assert renames.count() == df.where("zone <> 1").count()


def test_dense_ids_no_single_partition(spark):
    m = K.dense_ids(hot(spark), "user_id", partitions=4)
    p = plan(m)
    assert "SinglePartition" not in p and "Window" not in p, p
    assert rows(m.where("user_id < 3"), "user_id", "new_id") == [(0, 1), (1, 2), (2, 3)]


def test_many_tenant_merge_is_partial_aggregate(spark):
    a = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    b = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    out = M.merge_all_table([a, b], "k")
    p = plan(out)
    assert "Window" not in p.replace("WindowGroup", "") and "partial_max" in p and "SinglePartition" not in p, p
    assert out.count() == 150
    assert rows(out.where("k IN (49, 50)")) == [(49, "a"), (50, "b")]


def test_catalogue_scans_are_pruned(spark):
    p = plan(C.zone_revenue(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in p
    assert "PushedFilters: [In(o_orderstatus" in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_skewed_child_joins_are_correct(spark):
    e = hot(spark, 6000)
    keep = I.keep_map(I.survivors(e, "user_id", ["event_id"]), "user_id", "event_id")
    rp = I.repoint(e.withColumn("owner_guid", F.lit(-1)), "owner_guid", "user_id", keep)
    got = {r.user_id: r.owner_guid for r in rp.select("user_id", "owner_guid").distinct().collect()}
    assert got[0] == 0 and len(got) == 98


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_rows_that_a_shift_has_passed_go_around_the_merge(spark, tmp_path):
    """Main's scan inside the range isn't below the merge's exchange; the other one skips the range by pushed filters."""
    path = str(tmp_path / "m")
    spark.range(-5, 1000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("m").alias("v")).write.parquet(path)
    main = spark.read.parquet(path)
    sub = spark.createDataFrame([(-2, "s"), (0, "s"), (1001, "s"), (None, "s")], "k bigint, v string")
    out = M.merge_replace(main, sub, "k", shifted_by={"k": 999})
    assert rows(out) == rows(M.merge_replace(main, sub, "k"))
    no_broadcast(spark)
    try:
        p = plan(M.merge_replace(main, sub, "k", shifted_by={"k": 999}))
        union = p[p.index("Union"):]
        inside, rest = union.split("FileScan parquet")[1:3]
        assert "GreaterThan(k,0), LessThanOrEqual(k,999)" in inside and "Exchange" not in union.split("FileScan parquet")[0]
        assert "Or(LessThanOrEqual(k,0),GreaterThan(k,999))" in rest
        p = plan(C.zone_revenue(spark, SF))
        assert p.count("LessThanOrEqual(o_orderkey") and p.count("LessThanOrEqual(c_custkey")
        p = plan(C.rule_type1(spark, SF))
        assert p.count("LessThanOrEqual(c_custkey")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_purged_ids_are_worked_out_once(spark, tmp_path):
    from shardfold.model import Tenant
    from shardfold.operators import retention as R
    from shardfold.plans.reconcile import INACTIVE_PLAYER_CASCADE as CASCADE

    path = str(tmp_path / "players")
    spark.range(100).withColumnRenamed("id", "guid").write.parquet(path)
    child = lambda cols: spark.range(200).select(*[(F.col("id") + k).alias(c) for k, c in enumerate([cols] if isinstance(cols, str) else cols)])
    tables = {"t_player_info": spark.read.parquet(path), **{t: child(c) for t, c in CASCADE.items()}}
    for limit, joins in ((R.BROADCAST_BYTES, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        no_broadcast(spark)
        try:
            R.BROADCAST_BYTES, was = limit, R.BROADCAST_BYTES
            out = R.purge(Tenant("m", 1, tables), "t_player_info", "guid", "guid % 2 = 0", CASCADE)
            R.BROADCAST_BYTES = was
            plans = {t: plan(out.table(t)) for t in CASCADE}
            assert not any("FileScan" in p for p in plans.values()) and all(joins in p for p in plans.values())
            if limit:
                assert not any("Exchange hashpartitioning" in p for p in plans.values())
            for t, c in list(CASCADE.items())[-3:] + list(CASCADE.items())[:1]:
                gone = lambda v: v < 100 and v % 2 == 0
                want = [i for i in range(200) if not any(gone(i + k) for k in range(1 if isinstance(c, str) else len(c)))]
                first = c if isinstance(c, str) else c[0]
                assert [r[0] for r in rows(out.table(t), first)] == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
