"""Invariants over generated tenants (property style, few examples: each is a Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shardfold.model import Tenant
from shardfold.operators import identity as I
from shardfold.operators import keys as K
from shardfold.operators import merge as M

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.lists(st.integers(-3, 40), min_size=0, max_size=25, unique=True)


@SETTINGS
@given(keys, keys)
def test_replace_count_and_no_overlap(spark, a, b):
    main = spark.createDataFrame([(k, "m") for k in a], "k bigint, v string")
    sub = spark.createDataFrame([(k, "s") for k in b], "k bigint, v string")
    out = M.merge_replace(main, sub, "k")
    clashes = len(set(a) & set(b))
    assert out.count() == len(a) - clashes + len(b)
    # after a shift no positive key of the sub collides with main
    off = K.max_ids([Tenant("m", 1, {"t": main}), Tenant("s", 2, {"t": sub})], [("t", "k")])[("t", "k")]
    shifted = {r.k for r in K.shift(sub, "k", off).collect()}
    assert not {k for k in shifted if k > 0} & {k for k in a if k > 0}
    # K2 preserves order among positive keys
    pos = sorted(k for k in b if k > 0)
    assert sorted(k for k in shifted if k > 0) == [k + off for k in pos]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-50, 50)), min_size=1, max_size=30))
def test_fold_preserves_totals(spark, data):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(data)], "id bigint, k bigint, v bigint")
    out = I.fold(df, "k", ["id"], {"v": "sum"}, only_duplicates=False)
    assert sum(r.v for r in out.collect()) == sum(v for _, v in data)
    assert out.count() == len({k for k, _ in data})
    assert {r.id for r in out.collect()} == {min(i for i, (k2, _) in enumerate(data) if k2 == k) for k, _ in data}


@SETTINGS
@given(st.lists(st.integers(-5, 10_000), min_size=0, max_size=60))
def test_dense_ids_match_sorted_rank(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "x bigint")
    got = {r.x: r.new_id for r in K.dense_ids(df, "x", partitions=3).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(set(ids)))}


names = st.lists(st.tuples(st.sampled_from(["a", "b", "a.b", "c", "A"]), st.integers(1, 3)), min_size=1, max_size=20)


@SETTINGS
@given(names)
def test_rename_injective_on_name_zone(spark, data):
    from shardfold.operators import names as N
    df = spark.createDataFrame([(i + 1, n, z) for i, (n, z) in enumerate(data)], "id bigint, name string, zone int")
    renamed, _ = N.rename_duplicates(df, "name", "zone", 1, id_col="id")
    new = {r.id: r.name for r in renamed.collect()}
    pairs = {}
    for i, (n, z) in enumerate(data):
        pairs.setdefault(new[i + 1], set()).add((n, z) if new[i + 1] != n else ("same", n))
    # every new name comes from exactly one (old name, zone) pair; zone-1 rows keep their names
    assert all(len(v) == 1 for v in pairs.values())
    assert all(new[i + 1] == n for i, (n, z) in enumerate(data) if z == 1)


@SETTINGS
@given(st.lists(st.integers(1, 30), min_size=1, max_size=15, unique=True),
       st.lists(st.integers(1, 30), min_size=1, max_size=15, unique=True))
def test_group_shift_keeps_fks(spark, main_ids, sub_ids):
    from shardfold.model import Tenant
    def t(ids, name):
        return Tenant(name, 1, {"p": spark.createDataFrame([(i,) for i in ids], "id bigint"),
                                "c": spark.createDataFrame([(i, ids[i % len(ids)]) for i in range(len(ids))],
                                                           "cid bigint, ref bigint")})
    main, sub = t(main_ids, "m"), t(sub_ids, "s")
    grp = [("p", "id"), ("c", "ref")]
    s2 = K.shift_group(sub, grp, K.group_offset(main, sub, grp))
    parents = {r.id for r in s2.table("p").collect()}
    assert {r.ref for r in s2.table("c").collect()} <= parents
    assert not parents & set(main_ids)
