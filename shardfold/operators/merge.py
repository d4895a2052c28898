"""Merge operators: replace ("incoming wins"), append, insert-if-absent, filtered,
whole-tenant and many-tenant merges (M1-M8).

Two sources merge by an anti join of main with the incoming keys plus a
by-name union: main is shuffled on its key unless the incoming keys are small
enough to broadcast.  Any number of sources merge in one pass
(:func:`merge_all_table`), whose rows equal those of merging one by one.

Rows of one source that share a key are never chosen among: they win or lose
together, for any number of sources and key sets.  :func:`last_per_key`
resolves them where an order is declared.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..model import Tenant, TableSpec, _key_sets
from ..session import cut_lineage
from .lookup import spread


class MergeConflict(RuntimeError):
    """An append found incoming keys that already exist in the destination."""


def align(sub: DataFrame, main: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Project ``sub`` onto ``main``'s columns by name, cast to main's types (H2).

    The reference's ``SELECT *`` is positional; here columns are matched by name
    and a differing column set raises unless ``allow_missing`` (missing columns
    become NULL, extra ones are dropped).
    """
    mcols, scols = main.columns, set(sub.columns)
    missing = [c for c in mcols if c not in scols]
    extra = [c for c in sub.columns if c not in set(mcols)]
    if (missing or extra) and not allow_missing:
        raise ValueError(f"column sets differ: missing in source {missing}, extra in source {extra}")
    types = {f.name: f.dataType for f in main.schema.fields}
    sub_types = {f.name: f.dataType for f in sub.schema.fields}
    out = []
    for c in mcols:
        if c in scols:
            out.append(F.col(c) if sub_types[c] == types[c] else F.col(c).cast(types[c]).alias(c))
        else:
            out.append(F.lit(None).cast(types[c]).alias(c))
    return sub.select(*out)


def _any_null(keys: Sequence[str]):
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def last_per_key(df: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    """Resolve duplicate incoming keys: keep the last row by ``order_by`` (REPLACE order).

    A grouped ``max_by`` with map-side partial aggregation, so many copies of
    one key are reduced before the shuffle.  Rows need not be orderable.
    NULL keys never clash and are kept as they are.
    """
    from ..functions.columns import first_by

    order = [order_by] if isinstance(order_by, str) else list(order_by)
    null_key = _any_null(keys)
    payload = F.struct(*[F.col(c) for c in df.columns])
    last = df.where(~null_key).groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
        .agg(first_by(df, [(c, "desc") for c in order], payload).alias("__s")).select("__s.r.*")
    return last.unionByName(df.where(null_key))


def split_by_range(main: DataFrame, key: str, upto: int) -> tuple[DataFrame, DataFrame]:
    """Main's rows with ``0 < key <= upto`` and the others (NULL keys among them).

    A key column that was shifted by ``upto`` (K2-K4, K8, K9) holds no value in
    that range, so the first part can't clash with it.  Both filters reach
    the scan, and the second skips every file and row group inside the range.
    """
    k = F.col(key)
    return main.where((k > 0) & (k <= F.lit(upto))), main.where((k <= 0) | (k > F.lit(upto)) | k.isNull())


def merge_replace(main: DataFrame, sub: DataFrame, keys, order_by=None,
                  allow_missing: bool = False, shifted_by: Mapping[str, int] | None = None) -> DataFrame:
    """M1/M2 ``REPLACE INTO main SELECT * FROM sub``.

    Every main row that clashes with an incoming row on **any** unique key set
    is removed, then all incoming rows are added.  No keys = plain append
    (H1).  NULL key values never clash (as in a unique index).  ``order_by``
    resolves duplicate incoming keys to the last row.  ``shifted_by`` (column
    -> offset that the sub's positive values were shifted by): where the only
    key is such a column, main's rows that the shift has passed
    (:func:`split_by_range`) go around the join and its shuffle.
    """
    sub = align(sub, main, allow_missing)
    key_sets = _key_sets(keys)
    upto = (shifted_by or {}).get(key_sets[0][0], 0) if len(key_sets) == 1 and len(key_sets[0]) == 1 else 0
    if upto > 0:
        clear, main = split_by_range(main, key_sets[0][0], upto)
        return clear.unionByName(merge_replace(main, sub, key_sets, order_by))
    if order_by is not None:
        for ks in key_sets:
            sub = last_per_key(sub, list(ks), order_by)
    kept = main
    for ks in key_sets:
        kept = kept.join(sub.select(*ks), list(ks), "left_anti")
    return kept.select(*main.columns).unionByName(sub)


def merge_append(main: DataFrame, sub: DataFrame, keys=None, on_conflict: str = "error",
                 allow_missing: bool = False) -> DataFrame:
    """M3 ``INSERT INTO main SELECT * FROM sub``.

    ``on_conflict``: ``"error"`` (default; the reference's failing INSERT, H12)
    fails when a key clashes with main or repeats inside the sub (one grouped
    check, see :func:`merge_append_all`); ``"replace"`` = M1; ``"ignore"`` =
    M4 (``INSERT IGNORE``).
    """
    key_sets = _key_sets(keys)
    if on_conflict == "replace":
        return merge_replace(main, sub, key_sets, allow_missing=allow_missing)
    if on_conflict == "ignore":
        return merge_absent(main, sub, key_sets, allow_missing=allow_missing)
    if on_conflict != "error":
        raise ValueError(f"on_conflict must be error|replace|ignore, not {on_conflict!r}")
    return merge_append_all(main, [sub], key_sets, allow_missing)


def merge_append_all(main: DataFrame, subs: Sequence[DataFrame], keys, allow_missing: bool = False) -> DataFrame:
    """M3 for many subs at once: one clash check for all of them, then one union.

    A key held twice anywhere among main and the subs (NULL keys never
    clash) fails the append, as the row-by-row INSERTs would.  The check is
    one grouped count over the key columns of every source (map-side
    partial counts, so a hot key is reduced before the shuffle), instead
    of one join per sub against the growing table.
    """
    subs = [align(s, main, allow_missing) for s in subs]
    if not subs:
        return main
    for ks in _key_sets(keys):
        ks = list(ks)
        allk = main.select(*ks)
        for s in subs:
            allk = allk.unionByName(s.select(*ks))
        not_null = F.lit(True)
        for k in ks:
            not_null = not_null & F.col(k).isNotNull()
        clash = allk.where(not_null).groupBy(*ks).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").limit(1)
        if clash.count():
            raise MergeConflict(f"incoming rows clash on key {ks}")
    out = main
    for s in subs:
        out = out.unionByName(s)
    return out


def append_new_surrogate(main: DataFrame, sub: DataFrame, key: str, allow_missing: bool = False) -> DataFrame:
    """S6 insert without the surrogate column so new ids are assigned.

    Every incoming row gets ``max(main.key) + n`` with ``n`` = 1, 2, ... in
    ascending order of its old key (NULL old keys last), as an
    auto-increment continuing after main's max would: duplicate or NULL old
    keys still get ids of their own.  The numbering is the two-level
    :func:`shardfold.operators.keys.number_rows` (no single-partition
    window); main's max is one scalar job.
    """
    from .keys import number_rows

    sub = align(sub, main, allow_missing)
    base = main.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).first()[0]
    renum = number_rows(sub, [key], name="__n") \
        .withColumn(key, (F.lit(base) + F.col("__n")).cast(main.schema[key].dataType)).select(*main.columns)
    return main.unionByName(renum)


def merge_absent(main: DataFrame, sub: DataFrame, keys, allow_missing: bool = False) -> DataFrame:
    """M4 insert-if-absent (``WHERE NOT EXISTS`` / ``INSERT IGNORE``): main rows win."""
    sub = align(sub, main, allow_missing)
    for ks in _key_sets(keys):
        sub = sub.join(main.select(*ks), list(ks), "left_anti")
    return main.unionByName(sub.select(*main.columns))


def merge_absent_all(main: DataFrame, subs: Sequence[DataFrame], keys, allow_missing: bool = False) -> DataFrame:
    """M4 for any number of subs: the first source that holds a key keeps all its rows with that key."""
    return merge_all_table([main, *subs], keys, allow_missing, first_wins=True)


def merge_filtered(main: DataFrame, sub: DataFrame, keys, where, mode: str = "replace",
                   allow_missing: bool = False) -> DataFrame:
    """M5: M1/M3/M4 over ``sub WHERE cond`` (the filter reaches the sub's scan); an empty condition keeps every row."""
    if where is not None and not (isinstance(where, str) and not where.strip()):
        sub = sub.where(as_column(where))
    if mode == "replace":
        return merge_replace(main, sub, keys, allow_missing=allow_missing)
    if mode == "append":
        return merge_append(main, sub, keys, allow_missing=allow_missing)
    if mode == "absent":
        return merge_absent(main, sub, keys, allow_missing=allow_missing)
    raise ValueError(f"mode must be replace|append|absent, not {mode!r}")


def merge_table(main: DataFrame, sub: DataFrame, spec: TableSpec, mode: str = "replace",
                where=None, allow_missing: bool = False, shifted_by: Mapping[str, int] | None = None) -> DataFrame:
    if where is not None:
        return merge_filtered(main, sub, spec.keys, where, mode, allow_missing)
    if mode == "replace":
        return merge_replace(main, sub, spec.keys, allow_missing=allow_missing, shifted_by=shifted_by)
    if mode == "append":
        return merge_append(main, sub, spec.keys, allow_missing=allow_missing)
    if mode == "absent":
        return merge_absent(main, sub, spec.keys, allow_missing=allow_missing)
    raise ValueError(mode)


def merge_tenant(main: Tenant, sub: Tenant, exclude: Iterable[str] = (), on_missing: str = "skip",
                 where: Mapping[str, object] | None = None, mode: str = "replace",
                 allow_missing: bool = False, on_error: str = "raise",
                 shifted: Mapping[tuple[str, str], int] | None = None) -> tuple[Tenant, list[tuple[str, str]]]:
    """M6 whole-tenant merge: every sub table except ``exclude``.

    Returns the merged tenant (lazy) and the action per table: ``merged``,
    ``excluded`` (never read), ``missing`` (main lacks it; ``on_missing`` =
    ``skip`` | ``copy`` | ``error``), ``failed`` (only with ``on_error="skip"``:
    the table cannot be merged, e.g. its column set differs; main's rows are
    kept, it is logged and the rest goes on; by default it raises).  Tables
    only in main pass through.  ``shifted``: offset of each of the sub's
    shifted (table, column); see :func:`merge_replace`.
    """
    exclude = set(exclude)
    where = dict(where or {})
    by_table: dict[str, dict[str, int]] = {}
    for (t, c), off in (shifted or {}).items():
        by_table.setdefault(t, {})[c] = off
    out, actions = dict(main.tables), []
    for t in sub.names():
        if t in exclude:
            actions.append((t, "excluded"))
            continue
        if not main.has(t):
            if on_missing == "error":
                raise KeyError(f"main tenant {main.name!r} has no table {t!r}")
            if on_missing == "copy":
                src = sub.table(t)
                out[t] = src.where(as_column(where[t])) if t in where else src
                actions.append((t, "copied"))
            else:
                actions.append((t, "missing"))
            continue
        spec = main.spec(t) if main.spec(t).keys else sub.spec(t)
        try:
            out[t] = merge_table(main.table(t), sub.table(t), spec, mode, where.get(t), allow_missing, by_table.get(t))
        except (ValueError, AnalysisException) as e:
            if on_error != "skip":
                raise
            logging.getLogger(__name__).warning("table %s of %s not merged: %s", t, sub.name, e)
            actions.append((t, "failed"))
            continue
        actions.append((t, "merged"))
    specs = {**sub.specs, **main.specs}
    return Tenant(main.name, main.zone, out, specs), actions


def merge_all_table(frames: Sequence[DataFrame], keys, allow_missing: bool = False,
                    first_wins: bool = False) -> DataFrame:
    """M7 for one table: tenants in list order, the last one wins per key.

    Each key belongs to the last source that holds it, and all of that
    source's rows with the key stay; so the result equals merging the sources
    one by one, for one source or many.  The owner of a key is one grouped
    ``max`` of the tenant ordinal over the key columns alone (map-side
    partial, so a hot key is reduced before the shuffle); the rows follow by
    a join on key and ordinal.  NULL keys never clash and pass through.
    Several key sets: see :func:`_all_replaced` and :func:`_all_absent`; a
    keyless table is a union.  ``first_wins``: the earliest source
    keeps the key (insert-if-absent over many subs, M4).
    """
    key_sets = _key_sets(keys)
    base = frames[0]
    tagged = base.withColumn("__ord", F.lit(0))
    for i, f in enumerate(frames[1:], start=1):
        tagged = tagged.unionByName(align(f, base, allow_missing).withColumn("__ord", F.lit(i)))
    if not key_sets or len(frames) == 1:
        return tagged.drop("__ord")
    if len(key_sets) > 1:
        if not first_wins:
            kept = _all_replaced(tagged, key_sets)
        elif len(frames) == 2:  # main's rows all stay, so its keys alone decide
            kept = _all_replaced(tagged, key_sets, first_wins=True)
        else:
            kept = _all_absent(tagged, key_sets)
        return kept.select(*base.columns)
    ks = list(key_sets[0])
    null_key = _any_null(ks)
    owner = tagged.where(~null_key).groupBy(*ks).agg((F.min if first_wins else F.max)("__ord").alias("__ord"))
    # owner holds each (key, ordinal) once; an inner join stays above the union, so owner is planned once
    kept = tagged.where(~null_key).join(owner, [*ks, "__ord"])
    return kept.select(*base.columns).unionByName(tagged.where(null_key).select(*base.columns))


def _contested(tagged: DataFrame, ks: Sequence[str], i: int) -> DataFrame:
    """Keys of one set that several sources hold, as ``__<i>_k*``, with the first and last of them (``__<i>_lo``, ``__<i>_hi``)."""
    return tagged.where(~_any_null(ks)).groupBy(*[F.col(k).alias(f"__{i}_k{j}") for j, k in enumerate(ks)]) \
        .agg(F.min("__ord").alias(f"__{i}_lo"), F.max("__ord").alias(f"__{i}_hi")).where(F.col(f"__{i}_lo") < F.col(f"__{i}_hi"))


def _same_key(ks: Sequence[str], i: int):
    out = F.lit(True)
    for j, k in enumerate(ks):
        out = out & (F.col(k) == F.col(f"__{i}_k{j}"))
    return out


def _all_replaced(tagged: DataFrame, key_sets: Sequence[Sequence[str]], first_wins: bool = False) -> DataFrame:
    """Many sources, several key sets, incoming wins: one join per key set, for any number of sources.

    Every source's rows go in when their turn comes, whatever happened before,
    so a row stays exactly if no later source holds any of its keys.  Only
    keys that several sources hold are joined.
    """
    out = tagged
    for i, ks in enumerate(key_sets):
        lost = F.col("__ord") > F.col(f"__{i}_lo") if first_wins else F.col("__ord") < F.col(f"__{i}_hi")
        out = _by_hash(out, _contested(tagged, ks, i), ks, [f"__{i}_k{j}" for j in range(len(ks))]).where(~F.coalesce(lost, F.lit(False)))
    return out


def _by_hash(left: DataFrame, right: DataFrame, ks: Sequence[str], right_ks: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join on keys that ``right`` holds once each; rows with a NULL key are dealt by their content.

    (A left anti join would be pushed below the union of the sources, and the
    right side planned again for each of them.)
    """
    hashed = F.xxhash64(*ks) if null_safe else F.when(_any_null(ks), spread(left)).otherwise(F.xxhash64(*ks))
    left = left.withColumn("__h", hashed)
    right = right.withColumn("__rh", F.xxhash64(*right_ks))
    same = F.col("__h") == F.col("__rh")
    for k, r in zip(ks, right_ks):
        same = same & (F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r))
    return left.join(right, same, "left").drop("__h", "__rh")


def _all_absent(tagged: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Many sources, several key sets, insert if absent: a fixed point over the contested keys.

    A row keeps others out only if it got in itself, so one pass can't tell.
    Rows of one source with the same keys share their fate; what is decided is
    therefore each (source, keys) of which a key is contested.  In each round

    * out: an earlier source's row that is in holds one of its keys;
    * in: no earlier source's row that is in or open holds any of its keys;

    and the others stay open.  The first source left open is decided in
    every round, so there are at most as many rounds as sources.  Each round
    is written, has the same plan, and moves keys only; at the end
    the rows that are out leave by one join.
    """
    cols = list(dict.fromkeys(k for ks in key_sets for k in ks))
    cells = tagged.select("__ord", *cols).distinct()
    for i, ks in enumerate(key_sets):
        cells = cells.join(_contested(tagged, ks, i), _same_key(ks, i), "left")
    some = F.coalesce(*[F.col(f"__{i}_lo") for i in range(len(key_sets))]).isNotNull()
    cells = cut_lineage(cells.where(some).select("__ord", *cols, (F.col("__ord") == 0).alias("__in")))
    settled, left, gone = cells.where("__in"), cells.where("NOT __in"), []
    while True:
        live = settled.unionByName(left)
        state, out, blocked = left, F.lit(False), F.lit(False)
        for i, ks in enumerate(key_sets):
            first = live.where(~_any_null(ks)).groupBy(*[F.col(k).alias(f"__{i}_k{j}") for j, k in enumerate(ks)]).agg(
                F.min(F.when(F.col("__in"), F.col("__ord"))).alias(f"__{i}_in"), F.min("__ord").alias(f"__{i}_lo"))
            state = state.join(first, _same_key(ks, i), "left")
            out = out | F.coalesce(F.col(f"__{i}_in") < F.col("__ord"), F.lit(False))
            blocked = blocked | F.coalesce(F.col(f"__{i}_lo") < F.col("__ord"), F.lit(False))
        decided = cut_lineage(state.select("__ord", *cols, (~blocked).alias("__in"), out.alias("__out")))
        gone.append(decided.where("__out").select("__ord", *cols))
        settled = settled.unionByName(decided.where("__in").drop("__out"))
        left = decided.where("NOT __in AND NOT __out").drop("__out")
        if left.isEmpty():
            break
    losers = gone[0]
    for g in gone[1:]:
        losers = losers.unionByName(g)
    losers = losers.select(F.col("__ord").alias("__lord"), *[F.col(c).alias(f"__l{j}") for j, c in enumerate(cols)])
    out = _by_hash(tagged, losers, ["__ord", *cols], losers.columns, null_safe=True)
    return out.where(F.col("__lord").isNull())


def merge_all(main: Tenant, subs: Sequence[Tenant], exclude: Iterable[str] = (),
              on_missing: str = "skip") -> Tenant:
    """M7 many-tenant merge: subs applied in list order (later overwrites earlier)."""
    exclude = set(exclude)
    out = dict(main.tables)
    for t in main.names():
        if t in exclude:
            continue
        frames = [main.table(t)] + [s.table(t) for s in subs if s.has(t)]
        if len(frames) > 1:
            spec = main.spec(t)
            out[t] = merge_all_table(frames, spec.keys) if spec.keys else _union_all(frames)
    if on_missing == "copy":
        for s in subs:
            for t in s.names():
                if t not in out and t not in exclude:
                    out[t] = s.table(t)
    return Tenant(main.name, main.zone, out, main.specs)


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    acc = frames[0]
    for f in frames[1:]:
        acc = acc.unionByName(align(f, frames[0]))
    return acc


#: fixed values: account-database table and column candidates, in the order tried
ACCOUNT_TABLES = ("account", "user", "accounts", "users", "login")
ACCOUNT_NAME_COLUMNS = ("username", "account", "account_name", "name", "user_name")


def account_tables(tenant: Tenant) -> list[tuple[str, str]]:
    """Every candidate account table present, each with its first existing name column."""
    out = []
    for t in ACCOUNT_TABLES:
        if tenant.has(t):
            cols = tenant.table(t).columns
            for c in ACCOUNT_NAME_COLUMNS:
                if c in cols:
                    out.append((t, c))
                    break
    return out


def account_table(tenant: Tenant) -> tuple[str, str] | None:
    """The first candidate account table and its name column."""
    found = account_tables(tenant)
    return found[0] if found else None


def merge_accounts(main_acc: Tenant, sub_acc: Tenant, suffix: str, exclude: Iterable[str] = ()) -> Tenant:
    """M8 account-database merge.

    Every candidate account table of the sub gets ``suffix`` on its first
    existing name column unless the name already ends with it; then every
    table is merged as in M6.
    """
    from .names import affix  # local import: names depends on merge helpers

    if suffix:
        sub_acc = sub_acc.with_tables({t: affix(sub_acc.table(t), c, suffix, side="suffix", idempotent=True)
                                       for t, c in account_tables(sub_acc)})
    merged, _ = merge_tenant(main_acc, sub_acc, exclude=exclude)
    return merged
