"""Identity resolution (I1-I13): relink accounts, pick survivors, fold duplicates,
re-point foreign keys and delete orphans / losers.

Survivor choice is ``min(struct(order_key, row))`` in one ``groupBy``: Spark
aggregates it partially on the map side, so a key holding a third of all rows
is reduced before the shuffle instead of being sorted in one window task.
Ties are broken by a total order ending in the surrogate id (H14).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column, first_by, is_true
from .lookup import lookup


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order(order, prefer) -> list:
    out = []
    if prefer is not None:
        # preferred rows first: NOT prefer sorts False (= preferred) first
        out.append((~F.coalesce(as_column(prefer), F.lit(False)), "asc"))
    out.extend([order] if isinstance(order, (str, Column, tuple)) else list(order))
    return out


def survivors(df: DataFrame, key, order, prefer=None) -> DataFrame:
    """One row per ``key``: preferred rows first (e.g. ``zone = main``),
    then ``order`` (``[("level", "desc"), ..., "guid"]``).  Returns whole rows."""
    keys = _keys(key)
    payload = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
        .agg(first_by(df, _order(order, prefer), payload).alias("__s"))
    return best.select("__s.r.*")


def survivor_ids(df: DataFrame, key, order, id_col: str, prefer=None, keep_name: str = "keep") -> DataFrame:
    """``(key columns, keep)``: the ids of :func:`survivors`, without carrying whole rows through the shuffle."""
    keys = _keys(key)
    return df.groupBy(*keys).agg(first_by(df, _order(order, prefer), F.col(id_col), ties=[id_col])["r"].alias(keep_name))


#: fold kinds: how each column is folded into the survivor
FOLDS = ("sum", "min", "max", "sum_capped", "first")


def _fold_expr(c: str, kind) -> Column:
    cap = None
    if isinstance(kind, tuple):
        kind, cap = kind
    if kind == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    if kind == "sum_capped":
        return F.least(F.coalesce(F.sum(c), F.lit(0)), F.lit(cap))
    raise ValueError(f"fold kind must be one of {FOLDS}, not {kind!r}")


def fold(df: DataFrame, key, order, aggs: Mapping[str, object], prefer=None,
         only_duplicates: bool = True) -> DataFrame:
    """Fold every row of a key into its survivor.

    ``aggs``: column -> ``"sum"`` (``COALESCE(SUM, 0)``), ``"min"``, ``"max"``
    or ``("sum_capped", 200)`` (``LEAST(COALESCE(SUM, 0), 200)``).  Other
    columns keep the survivor's values.  As in the reference, keys with a
    single row are left untouched (``only_duplicates``).  One shuffle.
    """
    keys = _keys(key)
    payload = F.struct(*[F.col(c) for c in df.columns])
    agg = [first_by(df, _order(order, prefer), payload).alias("__s"), F.count(F.lit(1)).alias("__n")]
    agg += [_fold_expr(c, kind).alias(f"__f_{c}") for c, kind in aggs.items()]
    g = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(*agg)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in df.columns:
        if c in aggs:
            v = F.col(f"__f_{c}").cast(types[c])
            if only_duplicates:
                v = F.when(F.col("__n") > 1, v).otherwise(F.col(f"__s.r.{c}"))
            cols.append(v.alias(c))
        else:
            cols.append(F.col(f"__s.r.{c}").alias(c))
    return g.select(*cols)


def keep_map(survivor_rows: DataFrame, key: str, id_col: str, key_name: str = "key",
             keep_name: str = "keep") -> DataFrame:
    """``(key, keep)`` pairs from survivor rows, for re-pointing and loser deletes."""
    return survivor_rows.select(F.col(key).alias(key_name), F.col(id_col).alias(keep_name))


def repoint(child: DataFrame, set_col: str, on_col: str, keep: DataFrame,
            key_name: str = "key", keep_name: str = "keep") -> DataFrame:
    """I8 ``UPDATE c JOIN keep k ON c.on = k.key SET c.set_col = k.keep``."""
    if set_col not in child.columns or on_col not in child.columns:
        return child
    j = lookup(child, on_col, keep, key_name, {"__kk": key_name, "__kv": keep_name})
    return j.withColumn(set_col, F.when(F.col("__kk").isNotNull(), F.col("__kv").cast(child.schema[set_col].dataType))
                        .otherwise(F.col(set_col))).select(*child.columns)


def delete_orphans(child: DataFrame, fk: str, keep_ids: DataFrame, only=None) -> DataFrame:
    """I9 ``DELETE c LEFT JOIN keep ON c.fk = keep.id WHERE keep.id IS NULL [AND only]``.

    Without ``only`` this is a semi join; with it, rows outside ``only`` are
    kept whatever their key (``only IS NOT TRUE OR exists``).
    """
    ids = keep_ids.select(F.col(keep_ids.columns[0]).alias("__id"))
    if only is None:
        return child.join(ids, child[fk] == ids["__id"], "left_semi")
    marked = child.join(ids.distinct().withColumn("__hit", F.lit(True)), child[fk] == F.col("__id"), "left")
    return marked.where(~is_true(only) | F.col("__hit").isNotNull()).select(*child.columns)


def delete_losers(child: DataFrame, on_col: str, fk: str, keep: DataFrame, only=None,
                  key_name: str = "key", keep_name: str = "keep") -> DataFrame:
    """I10 ``DELETE r JOIN keep k ON r.on = k.key WHERE [only AND] r.fk <> k.keep``.

    A NULL ``fk`` compares as unknown and the row stays, as in SQL.
    """
    j = lookup(child, on_col, keep, key_name, {"__kk": key_name, "__kv": keep_name})
    lose = F.col("__kk").isNotNull() & F.coalesce(F.col(fk) != F.col("__kv"), F.lit(False))
    if only is not None:
        lose = lose & is_true(only)
    return j.where(~lose).select(*child.columns)


def relink_accounts(main_users: DataFrame, sub_users: DataFrame, id_col: str, name_col: str,
                    children: Mapping[str, tuple[DataFrame, str]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I1 same-account relink (``account_change = 999``).

    For every user name present on both sides the sub's child rows take the
    main user id and the sub's user row is deleted.  The (sub id -> main id)
    mapping is an inner join on the name; a name held twice on one side
    fails the job with ``raise_error`` (H10) instead of picking a row.
    """
    def one_per_name(df: DataFrame, alias: str) -> DataFrame:
        g = df.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("__name")) \
            .agg(F.min(id_col).alias(alias), F.count(F.lit(1)).alias("__c"))
        return g.select("__name", F.when(F.col("__c") > 1, F.raise_error(
            F.concat(F.lit(f"duplicate user name in {alias}: "), F.col("__name"))).cast("bigint"))
            .otherwise(F.col(alias)).alias(alias))

    mapping = one_per_name(sub_users, "sub_id").join(one_per_name(main_users, "main_id"), "__name") \
        .where((F.col("main_id") != 0) & (F.col("sub_id") != 0)).select("sub_id", "main_id")
    out = {}
    for name, (df, fk) in children.items():
        out[name] = repoint(df, fk, fk, mapping, "sub_id", "main_id")
    users = sub_users.join(mapping, sub_users[id_col] == mapping["sub_id"], "left_anti")
    return users, out


def collapse_counters(df: DataFrame, key, value: str, id_col: str, where=None) -> DataFrame:
    """Rows matching ``where`` collapse to one row per key with the summed value.

    The survivor is the smallest surrogate id (H13); other rows pass through.
    """
    hit = is_true(where) if where is not None else F.lit(True)
    rest = df.where(~hit)
    sel = df.where(hit)
    folded = fold(sel, key, [id_col], {value: "sum"}, only_duplicates=False)
    return rest.unionByName(folded)


def tie_classes(accounts: DataFrame, key: str, attrs: Sequence[str], zone: str, main_zone: int,
                id_col: str) -> DataFrame:
    """Ids of the account rows to keep, one class rule per key.

    * duplicates that agree on every attribute (``COUNT(*) > 1`` and one
      distinct value each): keep the main-zone rows;
    * single rows, or duplicates that disagree: keep the best row by
      ``attrs`` descending, then the smallest id.

    ``COUNT(DISTINCT a) = 1`` is computed as ``min(a) = max(a)`` (NULLs ignored
    alike), which keeps the aggregate a plain partial aggregate.
    """
    agg = [F.count(F.lit(1)).alias("__n"),
           first_by(accounts, [(a, "desc") for a in attrs] + [id_col], F.col(id_col), ties=[id_col])["r"].alias("__best")]
    for i, a in enumerate(attrs):
        agg += [F.min(a).alias(f"__mn{i}"), F.max(a).alias(f"__mx{i}")]
    agree, disagree = F.col("__n") > 1, F.col("__n") == 1
    for i in range(len(attrs)):
        agree = agree & F.coalesce(F.col(f"__mn{i}") == F.col(f"__mx{i}"), F.lit(False))
        disagree = disagree | F.coalesce(F.col(f"__mn{i}") < F.col(f"__mx{i}"), F.lit(False))
    per_key = accounts.groupBy(F.col(key).alias("__k")).agg(*agg).select("__k", "__best", agree.alias("__same"), disagree.alias("__best_only"))
    rows = accounts.select(key, id_col, zone).join(per_key, F.col(key).eqNullSafe(F.col("__k")))
    keep = (F.col("__same") & (F.col(zone) == main_zone)) | (F.col("__best_only") & F.col(id_col).eqNullSafe(F.col("__best")))
    return rows.where(keep).select(id_col)


def keep_richer_side(hire: DataFrame, accounts: DataFrame, records: DataFrame, main_zone: int,
                     shop: int = 34, accid: str = "accid", guid: str = "guid", zone: str = "zone_id",
                     owner: str = "owner", acc_guid: str = "acc_guid", shop_col: str = "shop_id") -> DataFrame:
    """For accounts with more than one hire row, keep the shop rows of the
    side (main zone vs other zones) with more purchase records; the other
    side's ``shop`` rows are deleted (a tie deletes main's).

    Each side's account is its smallest guid (the reference takes an
    arbitrary ``LIMIT 1``).  All per-account lookups become grouped counts
    and joins.
    """
    dup = hire.groupBy(accid).agg(F.count(F.lit(1)).alias("__h")).where("__h > 1").select(accid)
    sides = accounts.join(dup, accid, "left_semi").groupBy(accid).agg(
        F.min(F.when(F.col(zone) == main_zone, F.col(guid))).alias("__g1"),
        F.min(F.when(F.col(zone) != main_zone, F.col(guid))).alias("__g2"))
    sides = sides.where(F.col("__g1").isNotNull() & F.col("__g2").isNotNull() & (F.col("__g1") != 0) & (F.col("__g2") != 0))
    # only the records of the two guids are counted, once
    pairs = sides.select(F.col(accid).alias("__acc"), F.posexplode(F.array("__g1", "__g2")).alias("__side", "__g"))
    counts = records.select(F.col(acc_guid).alias("__g")).join(pairs.select("__g"), "__g", "left_semi").groupBy("__g").agg(F.count(F.lit(1)).alias("__c"))
    side = lambda c, k: F.max(F.when(F.col("__side") == k, c))
    n = F.coalesce(F.col("__c"), F.lit(0))
    d = pairs.join(counts, "__g", "left").groupBy("__acc").agg(
        F.when(side(n, 0) > side(n, 1), side(F.col("__g"), 1)).otherwise(side(F.col("__g"), 0)).alias("__lose"))
    cond = (records[owner] == d["__acc"]) & (records[acc_guid] == d["__lose"]) & (records[shop_col] == F.lit(shop))
    return records.join(d, cond, "left_anti")
