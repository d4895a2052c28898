"""Row-level rewrites: constants, conditional sets, value maps, stamps, deletes.

All are projections or filters: no shuffle, fused into the scan's codegen stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column, is_true


def _typed(df: DataFrame, c: str, value) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return v.cast(df.schema[c].dataType) if c in df.columns else v


def set_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P1 ``UPDATE t SET c = v``: every row, value cast to the column type."""
    return df.withColumns({c: _typed(df, c, v) for c, v in values.items()})


def set_where(df: DataFrame, pred, values: Mapping[str, object]) -> DataFrame:
    """P2 ``UPDATE t SET c = v WHERE pred`` (NULL predicate leaves the row)."""
    cond = is_true(pred)
    return df.withColumns({c: F.when(cond, _typed(df, c, v)).otherwise(F.col(c)) for c, v in values.items()})


def map_values(df: DataFrame, c: str, mapping: Mapping[object, object]) -> DataFrame:
    """P3 ``modify_table``: ``SET c = new WHERE c = old`` for each pair.

    The reference runs one UPDATE per pair; pairs are applied in order, so a
    value produced by an earlier pair can be mapped again by a later one.
    """
    for old, new in mapping.items():
        df = df.withColumn(c, F.when(F.col(c) == F.lit(old), _typed(df, c, new)).otherwise(F.col(c)))
    return df


def stamp_tenant(df: DataFrame, cols: Iterable[str], value) -> DataFrame:
    """P4 ``server_info``: set the server-id column(s) to the tenant id."""
    return set_const(df, {c: value for c in cols if c in df.columns})


def with_zone(df: DataFrame, zone: int, name: str = "zone_id") -> DataFrame:
    """P5 lineage column: the tenant a row came from."""
    return df.withColumn(name, F.lit(int(zone)).cast("int"))


def zone_of(df: DataFrame, c: str) -> int | None:
    """P5's scalar subquery ``(SELECT zoneid FROM t_player_info LIMIT 1)``.

    One tiny aggregate job; ``min`` instead of an arbitrary first row so the
    answer does not depend on file order.
    """
    return df.agg(F.min(c)).first()[0]


def widen(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P6 ``MODIFY COLUMN c BIGINT``."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols if c in df.columns})


def filter_rows(df: DataFrame, pred) -> DataFrame:
    """P7 ``WHERE cond`` on a merge input (pushed to the scan by Catalyst)."""
    return df.where(as_column(pred))


def delete_where(df: DataFrame, pred) -> DataFrame:
    """P8 ``DELETE FROM t WHERE pred``: rows with a NULL predicate are kept."""
    return df.where(~is_true(pred))


def empty(df: DataFrame) -> DataFrame:
    """P9 ``TRUNCATE``: no rows, same schema (Catalyst prunes the scan)."""
    return df.where(F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[tuple[str, object, object]]) -> DataFrame:
    """P10 ordered rule chain: ``(column, new_value, predicate)`` applied one after another.

    Each rule sees the previous rules' output (the reference runs them as
    successive UPDATEs), hence chained ``withColumn`` and never a single
    ``withColumns`` over the original values.  ``new_value`` is a Column, SQL
    text evaluated on the current row (e.g. ``"c + 10"``), or a Python literal;
    ``predicate`` may be None.
    """
    for c, value, pred in rules:
        v = as_column(value) if isinstance(value, (Column, str)) else F.lit(value)
        v = v.cast(df.schema[c].dataType) if c in df.columns else v
        if pred is None:
            df = df.withColumn(c, v)
        else:
            df = df.withColumn(c, F.when(is_true(pred), v).otherwise(F.col(c)))
    return df
