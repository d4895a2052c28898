"""Name-collision handling (N1-N8): affixes, conflict-only affixes, renaming
duplicates after an append, cascading renames and the compensation ledger.

Duplicate detection is a grouped count (map-side partial aggregation) joined
back on the name, not a ``count() OVER (PARTITION BY name)`` window: a name
held by a third of all rows would put that third into one window task.
Joins on a name go through :func:`shardfold.operators.lookup.lookup`, so a
common name or NULL doesn't gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import affixed, as_column, zone_of_guid
from .lookup import lookup


def affix(df: DataFrame, c: str, text: str, side: str = "prefix", skip: str | None = None,
          idempotent: bool = False, only=None) -> DataFrame:
    """N1 (all rows except ``skip``), N3 (``idempotent`` suffix), N4 (tenant prefix)."""
    if not text or c not in df.columns:
        return df
    return df.withColumn(c, affixed(c, text, side, skip, idempotent, only))


def tenant_prefix(df: DataFrame, c: str, zone: int, template: str = "s{zone}") -> DataFrame:
    """N4 ``CONCAT('s<zone>', name)``."""
    return affix(df, c, template.format(zone=zone), "prefix")


def name_marker(df: DataFrame, c: str, names: DataFrame, marker: str = "__hit", case_insensitive: bool = False) -> DataFrame:
    """Left-join a ``True`` marker for rows whose ``c`` is in ``names`` (semi-join as a column)."""
    fold = F.lower if case_insensitive else F.col
    n = names.select(fold(names.columns[0]).alias("__name")).where(F.col("__name").isNotNull()) \
        .distinct().withColumn(marker, F.lit(True))
    return lookup(df, fold(c), n, "__name", {marker: marker})


def affix_conflicts(sub: DataFrame, main: DataFrame, c: str, text: str, side: str = "prefix",
                    skip: str | None = None, main_col: str | None = None, case_insensitive: bool = False) -> DataFrame:
    """N2 ``repeat_modify``: affix only names that also exist in main's table.

    ``UPDATE sub SET c = CONCAT(..) WHERE c IN (SELECT c FROM main) AND c <> skip``.
    """
    if not text or c not in sub.columns:
        return sub
    j = name_marker(sub, c, main.select(main_col or c), case_insensitive=case_insensitive)
    return j.withColumn(c, affixed(c, text, side, skip, only=F.coalesce(F.col("__hit"), F.lit(False)))) \
        .drop("__hit").select(*sub.columns)


def duplicate_names(df: DataFrame, c: str, where=None, case_insensitive: bool = False) -> DataFrame:
    """Names held by more than one row (``GROUP BY BINARY c HAVING COUNT(c) > 1``); lower-cased if ``case_insensitive``."""
    src = df if where is None else df.where(where)
    name = F.lower(c) if case_insensitive else F.col(c)
    return src.where(F.col(c).isNotNull()).groupBy(name.alias(c)).agg(F.count(F.lit(1)).alias("__n")) \
        .where("__n > 1").select(c)


def rename_duplicates(df: DataFrame, c: str, zone: str | Column, main_zone: int, id_col: str | None = None,
                      template: str = "s%d.%s", where=None, only=None,
                      extra: Sequence[str] = (), case_insensitive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows whose name is duplicated and whose zone is not main's become ``s<zone>.<name>``.

    Comparison is binary unless ``case_insensitive`` (H16).  Rows with id 0 are left as
    they are (the reference skips them).  ``where`` narrows the rows that
    count as holders of a name (e.g. ``adventure_team_name <> ''``); ``only``
    is an extra condition on the renamed rows (e.g. ``accid <> 0``).
    Returns ``(renamed table, renames(id, old_name, new_name, zone, *extra))``.
    """
    zone_c = F.col(zone) if isinstance(zone, str) else zone
    where = None if where is None else as_column(where)
    dups = duplicate_names(df, c, where, case_insensitive).withColumn("__dup", F.lit(True)).withColumnRenamed(c, "__dname")
    # rows that can't be renamed (no name, outside ``where``) never meet a name
    name = F.lower(c) if case_insensitive else F.col(c)
    j = lookup(df, name if where is None else F.when(where, name), dups, "__dname", {"__dup": "__dup"})
    hit = F.coalesce(F.col("__dup"), F.lit(False)) & (zone_c != F.lit(main_zone))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    if only is not None:
        hit = hit & F.coalesce(as_column(only), F.lit(False))
    if id_col is not None:
        hit = hit & (F.col(id_col) != 0)
    j = j.withColumn("__ren", hit).withColumn("__old", F.col(c)) \
        .withColumn(c, F.when(F.col("__ren"), F.format_string(template, zone_c.cast("int"), F.col(c)))
                    .otherwise(F.col(c)))
    renamed = j.drop("__dup", "__ren", "__old").select(*df.columns)
    cols = ([F.col(id_col).alias("id")] if id_col else []) + [
        F.col("__old").alias("old_name"), F.col(c).alias("new_name"), zone_c.cast("int").alias("zone")] + [
        F.col(e) for e in extra]
    renames = j.where("__ren").select(*cols)
    return renamed, renames


def cascade(df: DataFrame, on_col: str, name_col: str, renames: DataFrame,
            id_col: str = "id", new_col: str = "new_name") -> DataFrame:
    """Copy the new name into a table that stores it by id (member, relation, ranking)."""
    if name_col not in df.columns or on_col not in df.columns:
        return df
    j = lookup(df, on_col, renames, id_col, {"__rname": new_col})
    return j.withColumn(name_col, F.coalesce(F.col("__rname"), F.col(name_col))).select(*df.columns)


def rename_ledger(renames: DataFrame, kind: int, id_col: str = "id", id_name: str = "guid") -> DataFrame:
    """One compensation row ``(guid|accid, name, type)`` per rename."""
    return renames.select(F.col(id_col).cast("bigint").alias(id_name), F.col("new_name").alias("name"),
                          F.lit(kind).cast("int").alias("type"))


def guild_ledger(renames: DataFrame, members: DataFrame, guild_col: str = "guildid",
                 member_id: str = "guid", member_name: str = "name", leader=None, kind: int = 2) -> DataFrame:
    """N7 for guilds: one ledger row per renamed guild, addressed to its leader.

    The row carries the leader's guid and the leader's own name (``post = 13``);
    with several leaders the smallest guid is taken, a guild without a leader
    gets no row.
    """
    from ..functions.columns import first_by

    leader = F.col("post") == 13 if leader is None else leader
    lead = members.where(F.coalesce(leader, F.lit(False))).groupBy(guild_col).agg(
        first_by(members, [member_id], F.struct(F.col(member_id).alias("g"), F.col(member_name).alias("n")))
        .alias("__l"))
    j = renames.join(lead, renames["id"] == lead[guild_col], "inner")
    return j.select(F.col("__l.r.g").cast("bigint").alias("guid"), F.col("__l.r.n").alias("name"),
                    F.lit(kind).cast("int").alias("type"))


def rename_guilds(guilds: DataFrame, name_col: str = "name", guid_col: str = "guid", main_zone: int = 1,
                  bits: int = 54) -> tuple[DataFrame, DataFrame]:
    """N5 on guild names, the zone read from the guid's top bits."""
    return rename_duplicates(guilds, name_col, zone_of_guid(guid_col, bits), main_zone, id_col=guid_col)
