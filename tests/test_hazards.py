
from shardfold.model import Tenant
from shardfold.operators import keys as K
from shardfold.operators import merge as M
from shardfold.operators import names as N
from shardfold.plans import jobs as J
from helpers import rows


def test_h1_keyless_tables_append(spark):
    a = spark.createDataFrame([(1, "x")], "owner bigint, v string")
    merged, _ = M.merge_tenant(Tenant("m", 1, {"log": a}), Tenant("s", 2, {"log": a}))
    assert merged.table("log").count() == 2


def test_h5_group_overflow_reported(spark):
    main = Tenant("m", 1, {"p": spark.createDataFrame([(1,), (2,)], "id bigint"),
                           "c": spark.createDataFrame([(9,)], "pid bigint")})
    sub = Tenant("s", 2, {"p": spark.createDataFrame([(1,)], "id bigint"),
                          "c": spark.createDataFrame([(1,)], "pid bigint")})
    assert K.group_overflow([main, sub], [("p", "id"), ("c", "pid")]) == {("c", "pid"): 9}
    assert K.group_overflow([main, sub], [("c", "pid"), ("p", "id")]) == {}


def test_h17_role_is_2_still_affixes(spark):
    t = lambda n: Tenant(n, 1, {"player": spark.createDataFrame([(1, "bob")], "id bigint, name string")}, {"player": "id"})
    rules = {"prefix_setting": {"role_is": "2", "additional_string": "2", "prefix": "_x",
                                "role_name": [{"db_table": "player", "db_field": "name", "not_equal": ""}]}}
    out = J.apply_names(t("m"), t("s"), rules)
    assert rows(out.table("player")) == [(1, "bob_x")]
    rules["prefix_setting"]["role_is"] = "0"
    assert rows(J.apply_names(t("m"), t("s"), rules).table("player")) == [(1, "bob")]


def test_h19_null_ids_pass_through(spark):
    df = spark.createDataFrame([(None, "a"), (3, "b")], "id bigint, v string")
    assert rows(K.shift(df, "id", 10)) == [(13, "b"), (None, "a")]
    t = Tenant("t", 1, {"x": df})
    assert rows(K.renumber(t, [("x", "id")]).table("x")) == [(1, "b"), (None, "a")]


def test_h24_quotes_in_values_are_data(spark):
    sub = spark.createDataFrame([(1, "o'brien"), (2, "a\\\\'); DROP")], "id bigint, name string")
    main = spark.createDataFrame([(5, "o'brien")], "id bigint, name string")
    out = N.affix_conflicts(sub, main, "name", "s2'", "prefix")
    assert rows(out) == [(1, "s2'o'brien"), (2, "a\\\\'); DROP")]
    from pyspark.sql import functions as F
    dup = main.withColumn("zone", F.lit(1)).unionByName(sub.withColumn("zone", F.lit(2)))
    renamed, _ = N.rename_duplicates(dup, "name", "zone", 1, id_col="id")
    assert "s2.o'brien" in [r.name for r in renamed.collect()]


def test_empty_tables_everywhere(spark):
    from shardfold.operators import identity as I
    e = spark.createDataFrame([], "id bigint, name string, zone int")
    one = spark.createDataFrame([(1, "a", 1)], "id bigint, name string, zone int")
    assert M.merge_replace(e, one, "id").count() == 1 and M.merge_replace(one, e, "id").count() == 1
    assert rows(M.append_new_surrogate(e, one, "id")) == [(1, "a", 1)]
    assert M.append_new_surrogate(one, e, "id").count() == 1
    assert K.dense_ids(e, "id").count() == 0
    assert K.renumber(Tenant("t", 1, {"x": e}), [("x", "id")]).table("x").count() == 0
    assert I.fold(e, "id", ["id"], {"zone": "sum"}).count() == 0
    assert I.survivors(e, "name", ["id"]).count() == 0
    renamed, renames = N.rename_duplicates(e, "name", "zone", 1, id_col="id")
    assert renamed.count() == 0 and renames.count() == 0
    assert M.merge_all_table([e, one, e], "id").count() == 1
    assert K.max_ids([Tenant("t", 1, {"x": e})], [("x", "id")]) == {("x", "id"): 0}
