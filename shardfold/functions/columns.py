"""Column-expression builders shared by the operators.

Everything here returns a ``Column`` made of built-in Spark functions, so it
stays inside whole-stage codegen; nothing here triggers a job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DoubleType, FloatType, MapType, NumericType, TimestampNTZType, TimestampType,
)

_LEADING = re.compile(r"^\s*(where|and)\s+", re.IGNORECASE)


def as_column(value) -> Column:
    """A Column from a Column, a column name or a SQL predicate text.

    Rule files carry predicates as text with an optional leading ``WHERE`` or
    ``AND``; that keyword is stripped and the rest parsed by Spark.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(_LEADING.sub("", value))
    raise TypeError(f"expected Column or SQL text, got {type(value).__name__}")


def is_true(pred) -> Column:
    """``pred IS TRUE``: NULL counts as false (SQL ``UPDATE/DELETE ... WHERE``)."""
    return F.coalesce(as_column(pred), F.lit(False))


def shifted(c: str | Column, offset: int) -> Column:
    """K2: ``c + offset`` for ``c > 0``; 0, negatives and NULL are left alone."""
    c = F.col(c) if isinstance(c, str) else c
    if not offset:
        return c
    return F.when(c > 0, c + F.lit(offset)).otherwise(c)


def affixed(c: str | Column, text: str, side: str = "prefix", skip: str | None = None,
            idempotent: bool = False, only: Column | None = None) -> Column:
    """Add ``text`` before or after ``c``.

    ``skip``: rows equal to it keep their value (and, as in SQL, NULL ``c`` gives
    a NULL comparison, so NULL stays NULL).  ``idempotent``: values already
    carrying the affix are left alone (literal ``startswith/endswith``, so
    ``_``/``%`` in the text are not wildcards).  ``only``: extra row condition.
    """
    c = F.col(c) if isinstance(c, str) else c
    if not text:
        return c
    lit = F.lit(text)
    new = F.concat(lit, c) if side == "prefix" else F.concat(c, lit)
    cond = F.lit(True)
    if skip is not None:
        cond = cond & (c != F.lit(skip))
    if idempotent:
        cond = cond & ~(c.startswith(text) if side == "prefix" else c.endswith(text))
    if only is not None:
        cond = cond & only
    return F.when(cond, new).otherwise(c)


def zone_of_guid(c: str | Column, bits: int = 54) -> Column:
    """Tenant number packed in the top bits of an unsigned 64-bit guid."""
    c = F.col(c) if isinstance(c, str) else c
    return F.shiftrightunsigned(c, bits)


def make_guid(zone: str | Column, local: str | Column, bits: int = 54) -> Column:
    """Inverse of :func:`zone_of_guid`: ``(zone << bits) + local``."""
    zone = F.col(zone) if isinstance(zone, str) else zone
    local = F.col(local) if isinstance(local, str) else local
    return F.shiftleft(zone.cast("bigint"), bits) + local.cast("bigint")


def digits_of(c: str | Column) -> Column:
    """Tenant number from a name: its digits as bigint, -1 when it has none."""
    c = F.col(c) if isinstance(c, str) else c
    d = F.regexp_replace(c, r"[^0-9]", "")
    return F.coalesce(F.nullif(d, F.lit("")).try_cast("bigint"), F.lit(-1).cast("bigint"))


def descending(c: Column, dtype: DataType) -> Column:
    """A key whose ascending order is the descending order of ``c``.

    Integers use bitwise NOT (order-reversing, never overflows); doubles are
    negated (NaN first); booleans negated; timestamps go through their microseconds.
    """
    if isinstance(dtype, BooleanType):
        return ~c
    if isinstance(dtype, TimestampNTZType):
        # wall-time micros built from date and time-of-day parts: no session
        # zone is involved, so DST gaps and overlaps cannot reorder rows
        micros = (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
                  + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
                  + F.minute(c).cast("bigint") * F.lit(60_000_000)
                  + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint"))
        return F.bitwise_not(micros)
    if isinstance(dtype, TimestampType):
        return F.bitwise_not(F.unix_micros(c))
    if isinstance(dtype, DateType):
        return F.bitwise_not(F.unix_date(c))
    if isinstance(dtype, NumericType):
        name = dtype.typeName()
        if name in ("byte", "short", "integer", "long"):
            return F.bitwise_not(c)
        if isinstance(dtype, (DoubleType, FloatType)):  # NaN is the largest value, so it comes first
            return F.struct(~F.isnan(c), -c)
        return -c
    raise TypeError(f"descending order on {dtype.simpleString()} is not supported; "
                    "order such columns ascending or map them to a number")


def _flippable(dtype: DataType) -> bool:
    return isinstance(dtype, (BooleanType, TimestampType, TimestampNTZType, DateType, NumericType))


def first_by(df, order, payload: Column, ties: list[str] | None = None) -> Column:
    """Aggregate picking ``payload`` of the first row in ``order`` within a group.

    ``order``: list of ``"col"`` / ``("col", "asc"|"desc")`` / ``(Column, dir)``.
    Built as ``min_by`` (or ``max_by``) of the payload by (order key, whole row): one grouped
    aggregate with map-side partial aggregation, so a key holding a third of
    all rows is reduced before the shuffle (a ``row_number`` window would
    sort that key in one task).  Numeric, boolean and time columns are flipped
    to get either direction; string columns cannot be flipped, so they must
    all share one direction (``max`` is used when they are descending).
    ``ties``: the columns that break ties, where not the whole row (a unique
    id is enough and keeps the other columns out of the shuffle).
    """
    items = []
    for item in order:
        if isinstance(item, (str, Column)):
            item = (item, "asc")
        c, direction = item
        if isinstance(c, str):
            dtype = df.schema[c].dataType
            c = F.col(c)
        else:
            dtype = df.select(c).schema.fields[0].dataType
        items.append((c, dtype, direction))
    fixed = {d for _, dt, d in items if not _flippable(dt)}
    if len(fixed) > 1:
        raise TypeError("string order columns must all be ascending or all descending")
    use_max = fixed == {"desc"}
    # NULLs sort first ascending and last descending (MySQL order).  Under min
    # a NULL struct field is smallest, under max it is largest-last; where the
    # flipped key would put NULLs on the wrong end a null flag goes first.
    parts = []
    for i, (c, dt, d) in enumerate(items):
        flip = (d == "desc") != use_max
        if flip:
            parts.append(c.isNull().alias(f"n{i}"))
            parts.append(descending(c, dt).alias(f"o{i}"))
        else:
            parts.append(c.alias(f"o{i}"))
    # ties are broken by the whole row (or ``ties``); maps can't be ordered, so they go by their sorted entries
    rest = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, MapType) else F.col(f.name)
            for f in df.schema.fields if ties is None or f.name in ties]
    key = F.struct(F.struct(*parts), F.struct(*rest))
    chosen = F.struct(F.struct(*parts).alias("o"), payload.alias("r"))
    return (F.max_by if use_max else F.min_by)(chosen, key)
