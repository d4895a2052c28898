"""Data model: a tenant is a named, zoned set of lazily-read DataFrames.

A *tenant* is one server database (main = destination, sub = source).  Its
tables are plain DataFrames, so every operator in this package is a pure
``DataFrame -> DataFrame`` function that Catalyst plans as a whole.  Unique
keys are declared explicitly with :class:`TableSpec` because a DataFrame has
no DDL (a table without keys is merged by append).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame


def _key_sets(keys) -> tuple[tuple[str, ...], ...]:
    """Normalise ``"k"``, ``["k"]``, ``[["a"], ["b", "c"]]`` to a tuple of key sets."""
    if not keys:
        return ()
    if isinstance(keys, str):
        return ((keys,),)
    keys = list(keys)
    if all(isinstance(k, str) for k in keys):
        return (tuple(keys),)
    return tuple((k,) if isinstance(k, str) else tuple(k) for k in keys)


@dataclass(frozen=True)
class TableSpec:
    """Unique key sets of one table; the first is the primary key."""

    keys: tuple[tuple[str, ...], ...] = ()

    @staticmethod
    def of(keys=None) -> "TableSpec":
        return TableSpec(_key_sets(keys))

    @property
    def primary(self) -> tuple[str, ...]:
        return self.keys[0] if self.keys else ()


@dataclass(frozen=True)
class Tenant:
    """One database: ``name``, its ``zone`` number and its tables."""

    name: str
    zone: int
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    specs: Mapping[str, TableSpec] = field(default_factory=dict)
    #: maxima already known for (table, column): K1 uses them instead of scanning
    known_max: Mapping[tuple[str, str], int] = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "known_max", MappingProxyType(dict(self.known_max)))
        object.__setattr__(self, "tables", MappingProxyType(dict(self.tables)))
        object.__setattr__(self, "specs", MappingProxyType(
            {t: s if isinstance(s, TableSpec) else TableSpec.of(s) for t, s in self.specs.items()}))

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def has(self, name: str) -> bool:
        return name in self.tables

    def names(self) -> list[str]:
        return list(self.tables)

    def spec(self, name: str) -> TableSpec:
        return self.specs.get(name, TableSpec())

    def replace(self, **tables: DataFrame) -> "Tenant":
        """A new tenant with some tables swapped (tenants are never mutated)."""
        return self.with_tables(tables)

    def with_tables(self, tables: Mapping[str, DataFrame], drop: Iterable[str] = ()) -> "Tenant":
        """A new tenant with tables swapped; known maxima of swapped tables are forgotten."""
        merged = {**self.tables, **tables}
        drop = set(drop)
        for t in drop:
            merged.pop(t, None)
        known = {k: v for k, v in self.known_max.items() if k[0] not in tables and k[0] not in drop}
        return Tenant(self.name, self.zone, merged, self.specs, known)

    def with_specs(self, specs: Mapping[str, object]) -> "Tenant":
        return Tenant(self.name, self.zone, self.tables, {**self.specs, **specs}, self.known_max)

    def with_known_max(self, known: Mapping[tuple[str, str], int]) -> "Tenant":
        return Tenant(self.name, self.zone, self.tables, self.specs, known)

    def columns_named(self, column: str) -> list[str]:
        """Tables that have a column called ``column`` (schema probe, no job)."""
        return [t for t, df in self.tables.items() if column in df.columns]
