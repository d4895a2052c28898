"""Key remapping (K1-K9, K11): offsets, shifts, dense renumbering, ids in text.

Scale rules: only per-column maxima reach the driver (one aggregate job per
call covering every requested column of every table), shifts are projections,
and the dense renumbering ranks ids with a range-partitioned, checkpointed
two-level numbering instead of a single-partition window.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_true, shifted
from ..model import Tenant
from ..session import cut_lineage
from .lookup import lookup

Col = tuple[str, str]  # (table, column)


# ---------------------------------------------------------------- K1 max ids
def max_ids_frame(tenants: Sequence[Tenant], cols: Iterable[Col]) -> DataFrame | None:
    """K1 as a lazy DataFrame ``(tenant, table_name, column_name, max_id)``.

    ``IFNULL(MAX(c), 0)``; one aggregate per (tenant, table) covering all of
    that table's requested columns.  Missing tables/columns produce no row
    (read as 0).
    """
    by_table: dict[str, list[str]] = {}
    for t, c in cols:
        if c not in by_table.setdefault(t, []):
            by_table[t].append(c)
    parts = []
    for ten in tenants:
        for t, cs in by_table.items():
            if not ten.has(t):
                continue
            df = ten.table(t)
            present = [c for c in cs if c in df.columns and (t, c) not in ten.known_max]
            if not present:
                continue
            agg = df.agg(*[F.coalesce(F.max(F.col(c)).cast("bigint"), F.lit(0).cast("bigint")).alias(c)
                           for c in present])
            parts.append(agg.select(
                F.lit(ten.name).alias("tenant"), F.lit(t).alias("table_name"),
                F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("max_id"))
                                   for c in present]))))
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts)


def max_ids(tenants: Sequence[Tenant], cols: Iterable[Col]) -> dict[Col, int]:
    """K1: ``max(IFNULL(MAX(c), 0))`` over all ``tenants`` per (table, column); one job."""
    cols = list(cols)
    out = {tc: 0 for tc in cols}
    for ten in tenants:
        for tc in cols:
            if tc in ten.known_max:
                out[tc] = max(out[tc], int(ten.known_max[tc]))
    frame = max_ids_frame(tenants, cols)
    if frame is None:
        return out
    for r in frame.collect():  # at most tenants x columns rows
        key = (r["table_name"], r["column_name"])
        out[key] = max(out.get(key, 0), int(r["max_id"]))
    return out


# --------------------------------------------------------------- K2-K4 shift
def shift(df: DataFrame, c: str, offset: int) -> DataFrame:
    """K2 ``SET c = c + off WHERE c > 0`` (offset 0 is a no-op)."""
    if not offset or c not in df.columns:
        return df
    return df.withColumn(c, shifted(c, offset))


def shift_columns(tenant: Tenant, offsets: Mapping[Col, int]) -> Tenant:
    """Apply several K2 shifts; all shifts of one table become one projection."""
    per_table: dict[str, dict[str, Column]] = {}
    for (t, c), off in offsets.items():
        if off and tenant.has(t) and c in tenant.table(t).columns:
            per_table.setdefault(t, {})[c] = shifted(c, off)
    return tenant.with_tables({t: tenant.table(t).withColumns(cs) for t, cs in per_table.items()})


def group_offset(main: Tenant, sub: Tenant, group: Sequence[Col]) -> int:
    """K3 offset of a group = max of its **first** member over main and sub (H5)."""
    first = tuple(group[0])
    return max_ids([main, sub], [first])[first]


def group_overflow(tenants: Sequence[Tenant], group: Sequence[Col]) -> dict[Col, int]:
    """H5 check: members whose max exceeds the first member's max.

    The group offset comes from the first member only, so a foreign key above
    that max (an orphan) can collide after the shift.  Returns the offending
    members with their max (empty = safe); one aggregate job.
    """
    maxes = max_ids(tenants, [tuple(m) for m in group])
    first = maxes[tuple(group[0])]
    return {m: v for m, v in maxes.items() if v > first}


def shift_group(sub: Tenant, group: Sequence[Col], offset: int) -> Tenant:
    """K3 ``same``: every member column shifted by the group's one offset."""
    return shift_columns(sub, {tuple(m): offset for m in group})


def shift_each(main: Tenant, sub: Tenant, cols: Sequence[Col]) -> tuple[Tenant, dict[Col, int]]:
    """K4 ``other_identity``: each (table, column) shifted by its own max."""
    offs = max_ids([main, sub], [tuple(c) for c in cols])
    return shift_columns(sub, offs), offs


def shift_when(df: DataFrame, c: str, offset: int, pred=None) -> DataFrame:
    """K6 ``special_field``: ``SET c = c + off <WHERE pred>`` (no ``> 0`` guard)."""
    if not offset or c not in df.columns:
        return df
    new = F.col(c) + F.lit(offset)
    return df.withColumn(c, new if pred is None or pred == "" else F.when(is_true(pred), new).otherwise(F.col(c)))


# --------------------------------------------------------------- K5 renumber
def number_rows(df: DataFrame, order: Sequence[str], partitions: int | None = None, name: str = "__row") -> DataFrame:
    """Number the rows of ``df`` 1..n in ``order`` (NULLs last), without a single-partition window.

    Rows are range partitioned on ``order`` and then on a hash of the whole
    row, so one key (or NULL) on many rows is spread over partitions, and
    sorted by ``order``, that hash and the row's text inside each partition:
    ties are numbered in one fixed order.  Rows are numbered locally;
    per-partition counts (one number per partition) give each partition's base.  The numbered rows are
    checkpointed so the counting and numbering jobs see the same
    partitioning, also after an executor loss.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    keys = [*[F.col(c).asc_nulls_last() for c in order], F.xxhash64(row)]
    local = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys, row)
             .withColumn("__mid", F.monotonically_increasing_id()))
    local = cut_lineage(local.withColumn("__p", F.shiftright("__mid", 33).cast("int"))
                        .withColumn("__i", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("__mid"))
    counts = dict((r["__p"], r["n"]) for r in local.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect())
    bases, acc = [], 0
    for p in range(max(counts, default=-1) + 1):
        bases.append(acc)
        acc += counts.get(p, 0)
    if not bases:
        return local.drop("__p", "__i").withColumn(name, F.lit(None).cast("bigint"))
    base = F.array(*[F.lit(b).cast("bigint") for b in bases])
    return local.withColumn(name, F.element_at(base, F.col("__p") + 1) + F.col("__i") + 1).drop("__p", "__i")


def dense_ids(ids: DataFrame, c: str, partitions: int | None = None) -> DataFrame:
    """Mapping ``(c, new_id)``: distinct non-null ``c`` ranked 1..n in ascending order
    (:func:`number_rows` over the distinct values)."""
    d = ids.select(F.col(c)).where(F.col(c).isNotNull()).distinct()
    return number_rows(d, [c], partitions, "new_id").select(F.col(c), "new_id")


def apply_mapping(df: DataFrame, c: str, mapping: DataFrame, pred=None) -> DataFrame:
    """Replace ``c`` by ``mapping.new_id`` where mapped (and ``pred`` holds)."""
    if c not in df.columns:
        return df
    j = lookup(df, c, mapping, mapping.columns[0], {"__new": "new_id"})
    cond = F.col("__new").isNotNull()
    if pred is not None and pred != "":
        cond = cond & is_true(pred)
    return j.withColumn(c, F.when(cond, F.col("__new").cast(df.schema[c].dataType)).otherwise(F.col(c))).select(*df.columns)


def dense_ids_many(frames: Sequence[DataFrame], c: str, partitions: int | None = None) -> list[DataFrame]:
    """:func:`dense_ids` for several tenants at once: one numbering pass, one checkpoint.

    Distinct ids are tagged with their tenant, numbered in (tenant, id)
    order, and each tenant's count (one number per tenant) turns the global
    number into that tenant's own 1..n rank.
    """
    if len(frames) == 1:
        return [dense_ids(frames[0], c, partitions)]
    tagged = None
    for i, f in enumerate(frames):
        d = f.select(F.lit(i).alias("__t"), F.col(c)).where(F.col(c).isNotNull()).distinct()
        tagged = d if tagged is None else tagged.unionByName(d)
    numbered = number_rows(tagged, ["__t", c], partitions, "__g")
    counts = dict((r["__t"], r["n"]) for r in numbered.groupBy("__t").agg(F.count(F.lit(1)).alias("n")).collect())
    out, acc = [], 0
    for i in range(len(frames)):
        out.append(numbered.where(F.col("__t") == i).select(F.col(c), (F.col("__g") - F.lit(acc)).alias("new_id")))
        acc += counts.get(i, 0)
    return out


Text = tuple[str, str, str]  # (table, column, delimiter): ids written inside a text


def renumber_maps(tenants: Sequence[Tenant], group: Sequence, partitions: int | None = None) -> list[DataFrame | None]:
    """The K5 mapping ``(id, new_id)`` of each tenant's own ids, in one numbering pass; None where the first member's table is missing."""
    t0, c0 = group[0][0], group[0][1]
    cond0 = group[0][2] if len(group[0]) > 2 else None
    live = [i for i, t in enumerate(tenants) if t.has(t0)]
    srcs = []
    for i in live:
        src = tenants[i].table(t0)
        srcs.append((src.where(is_true(cond0)) if cond0 else src).select(c0))
    maps = dict(zip(live, dense_ids_many(srcs, c0, partitions))) if live else {}
    return [maps.get(i) for i in range(len(tenants))]


def apply_group(tenant: Tenant, group: Sequence, mapping: DataFrame | None, texts: Sequence[Text] = ()) -> Tenant:
    """One mapping on every member of a group (with that member's condition) and on the ids inside ``texts``."""
    if mapping is None:
        return tenant
    upd = {}
    for m in group:
        t, c = m[0], m[1]
        if tenant.has(t):
            upd[t] = apply_mapping(upd.get(t, tenant.table(t)), c, mapping, m[2] if len(m) > 2 else None)
    for t, c, delimiter in texts:
        if tenant.has(t):
            upd[t] = map_tokens(upd.get(t, tenant.table(t)), c, mapping, delimiter, tenant.spec(t).primary or None)
    return tenant.with_tables(upd)


def renumber_many(tenants: Sequence[Tenant], group: Sequence, partitions: int | None = None,
                  texts: Sequence[Text] = ()) -> list[Tenant]:
    """K5 over several tenants (each renumbered 1..n on its own) with one numbering pass."""
    maps = renumber_maps(tenants, group, partitions)
    return [apply_group(t, group, m, texts) for t, m in zip(tenants, maps)]


def renumber(tenant: Tenant, group: Sequence, partitions: int | None = None) -> Tenant:
    """K5 ``restructure_tool``: renumber a group's ids 1..n in ascending order.

    ``group``: ``[(table, column[, condition]), ...]``.  The ids of the first
    member (rows matching its condition) define one mapping, which is applied
    to **every** member with that member's condition (H7; the reference
    updates only the first member, row by row).
    """
    return renumber_many([tenant], group, partitions)[0]


# ------------------------------------------------------- K7 ids inside text
def _split(c: Column, delimiter: str) -> Column:
    return F.split(c, "\\Q" + delimiter + "\\E", -1)


def _shift_token(tok: Column, offset: int) -> Column:
    num = tok.try_cast("bigint")
    return F.when(num > 0, (num + F.lit(offset)).cast("string")).otherwise(tok)


def shift_tokens(df: DataFrame, c: str, offset: int, delimiter: str = ",",
                 valid_ids: DataFrame | None = None, row_key: Sequence[str] | str | None = None) -> DataFrame:
    """K7 ``teshudb_field``: shift the ids written inside a delimited text column.

    Token-wise (H6): ``1,12`` with +10 is ``11,22``, never ``11,112``.  Without
    ``valid_ids`` every positive integer token moves (a projection, no
    shuffle).  With ``valid_ids`` (one-column DataFrame of the attribution
    ids) only tokens naming one of them move: tokens are exploded with their
    position, joined to the distinct ids and re-assembled per row, so each
    group is one row's own tokens.  Rows are re-assembled by ``row_key`` (a
    unique key of ``df``); without one, rows are numbered and the numbered
    table is checkpointed so both uses see the same numbers.
    """
    if not offset or c not in df.columns:
        return df
    if valid_ids is None:
        return df.withColumn(c, F.array_join(F.transform(_split(F.col(c), delimiter),
                                                         lambda x: _shift_token(x, offset)), delimiter))
    ids = valid_ids.select(F.col(valid_ids.columns[0]).cast("bigint").alias("id")).where(F.col("id") > 0).distinct()
    return map_tokens(df, c, ids.withColumn("new_id", F.col("id") + F.lit(offset)), delimiter, row_key)


def map_tokens(df: DataFrame, c: str, mapping: DataFrame, delimiter: str = ",",
               row_key: Sequence[str] | str | None = None) -> DataFrame:
    """K7 through a mapping: tokens that name an id of ``mapping`` (first column -> ``new_id``) become its new id.

    Tokens are exploded with their position and looked up like any foreign
    key (a token on half of all rows meets no single task); the others stay
    as they are written.  Rows are put together again by ``row_key`` (a
    unique key of ``df``); without one, rows are numbered and the numbered
    table is checkpointed so both uses see the same numbers.
    """
    if c not in df.columns:
        return df
    if row_key:
        keys = [row_key] if isinstance(row_key, str) else list(row_key)
        base = df.withColumn("__rid", F.struct(*[F.col(k) for k in keys]))
    else:
        base = cut_lineage(df.withColumn("__rid", F.monotonically_increasing_id()))
    toks = base.where(F.col(c).isNotNull()) \
        .select("__rid", F.posexplode(_split(F.col(c), delimiter)).alias("__pos", "__tok"))
    toks = lookup(toks, F.col("__tok").try_cast("bigint"), mapping, mapping.columns[0], {"__id": "new_id"}) \
        .withColumn("__new", F.coalesce(F.col("__id").cast("string"), F.col("__tok")))
    rebuilt = toks.groupBy("__rid").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("__pos", "__new"))), lambda x: x["__new"]), delimiter).alias("__txt"))
    return base.join(rebuilt, "__rid", "left") \
        .withColumn(c, F.when(F.col(c).isNull(), F.col(c)).otherwise(F.col("__txt"))) \
        .drop("__rid", "__txt").select(*df.columns)


# ------------------------------------------------ K8 / K9 name-based shifts
def associated_columns(sub: Tenant, rule: Mapping[str, str]) -> list[Col]:
    """The columns that one ``deal_with`` rule shifts: the declared one and every column named ``associated``."""
    out = [(rule["db_table"], rule["db_field"])]
    if rule.get("associated"):
        out += [(t, rule["associated"]) for t in sub.columns_named(rule["associated"])]
    return out


def shift_associated(main: Tenant, sub: Tenant, rules: Sequence[Mapping[str, str]]) -> tuple[Tenant, dict[Col, int]]:
    """K8 ``deal_with``: shift ``table.field`` and every column named ``associated``.

    Offsets come from the declared (table, field) over main and sub, all
    computed in one job before any rewrite.  Each (table, column) is shifted
    once (H4): the declaring column is not shifted again as its own
    ``associated`` name.
    """
    decl = [(r["db_table"], r["db_field"]) for r in rules]
    offs = max_ids([main, sub], decl)
    plan: dict[Col, int] = {}
    for r in rules:
        for c in associated_columns(sub, r):
            plan.setdefault(c, offs[(r["db_table"], r["db_field"])])
    return shift_columns(sub, plan), plan


def shift_by_column_name(main: Tenant, sub: Tenant, names: Iterable[str],
                         done: Iterable[Col] = ()) -> tuple[Tenant, dict[Col, int]]:
    """K9 ``primary_key``: every table having a column named X shifts it by that table's own max.

    Columns already remapped (``done``, e.g. by K8) are skipped (H4); a max
    of 0 or less leaves the column alone.
    """
    done = set(done)
    targets = [(t, n) for n in names for t in sub.columns_named(n) if (t, n) not in done]
    offs = max_ids([main, sub], targets)
    offs = {k: v for k, v in offs.items() if v > 0}
    return shift_columns(sub, offs), offs
