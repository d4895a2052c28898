"""Renumbering (K5) over many subs without rewriting main for each of them.

Before each sub, a rule document with renumbering numbers main's ids 1..n
anew.  What main's rows then hold is a function of what they held when they
came in, so main's tables can wait: :class:`Composition` keeps, for each
group, one function per sub as a table ``(old, new_id)``, and at the end puts
together, for every source, the functions that came after it.

After the first function main's ids are 1..n, and so they stay: a later
function moves only ids of the last sub that lie above n and leave a gap.
Where they leave none, it is the identity and nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Tenant
from ..operators import keys as K
from ..session import cut_lineage
from .remap import renumber_groups


def composable(rules: Mapping, main: Tenant, subs: Sequence[Tenant], known: Sequence[tuple[str, str]]) -> bool:
    """True if the ids that main holds before each sub follow from the sources' own ids.

    So they do where each group's first member has no condition and is its
    table's only key, or the table has none (a replaced row's id comes
    back with the row that replaces it); where no other member is part of a
    key (two of its values could become one); where no column is in two
    groups; and where each maximum (``known``) asked of a group's tables is of
    a first member, of an only key, or of a table without keys.
    """
    specs = lambda t: {ks for x in (main, *subs) for ks in x.spec(t).keys}
    members = {m[:2] for group, _ in renumber_groups(rules) for m in group}
    firsts = {group[0][:2] for group, _ in renumber_groups(rules)}
    if any(t in {x for x, _ in members} and (t, c) not in firsts and ((t, c) in members or specs(t) - {(c,)}) for t, c in known):
        return False
    seen: set[tuple[str, str]] = set()
    for group, _ in renumber_groups(rules):
        first = group[0][:2]
        for t, c, cond in group:
            keys = specs(t)
            if (t, c) in seen or (t, c) == first and (cond or keys - {(c,)}):
                return False
            if (t, c) != first and any(c in ks for ks in keys):
                return False
            seen.add((t, c))
    return True


def then(f: DataFrame | None, g: DataFrame | None) -> DataFrame | None:
    """``g`` after ``f``; each moves the ids it holds and leaves the others.  None is the identity."""
    if f is None or g is None:
        return g if f is None else f
    later = g.select(F.col("old").alias("__o"), F.col("new_id").alias("__n"))
    moved = f.join(later, F.col("new_id") == F.col("__o"), "left").select("old", F.coalesce("__n", "new_id").alias("new_id"))
    return cut_lineage(moved.unionByName(g.join(f.select("old"), "old", "left_anti")))


class Composition:
    """The functions of each group so far; ``sizes`` are main's id counts, which are its maxima too."""

    def __init__(self, main: Tenant, rules: Mapping):
        self.groups = [(g, texts) for g, texts in renumber_groups(rules) if main.has(g[0][0])]
        self.steps: list[list[DataFrame | None]] = [[] for _ in self.groups]
        self.sizes: list[int] = []
        for k, (group, _) in enumerate(self.groups):
            mapping = K.renumber_maps([main], group)[0]
            mapping = mapping.select(F.col(mapping.columns[0]).cast("bigint").alias("old"), "new_id")
            self.steps[k].append(mapping)
            self.sizes.append(int(mapping.agg(F.coalesce(F.max("new_id"), F.lit(0))).first()[0]))

    def known(self) -> dict[tuple[str, str], int]:
        return {group[0][:2]: n for (group, _), n in zip(self.groups, self.sizes)}

    def take(self, sub: Tenant, merged: set[str]) -> None:
        """The next function of each group: what ``sub``'s merged ids do to main's numbering."""
        for k, (group, _) in enumerate(self.groups):
            t, c = group[0][:2]
            step = None
            if t in merged:
                n = self.sizes[k]
                ids = sub.table(t).where(F.col(c) > n).select(F.col(c).cast("bigint").alias("old")).distinct()
                row = ids.agg(F.count(F.lit(1)).alias("n"), F.max("old").alias("top")).first()
                if row["n"] and row["top"] != n + row["n"]:  # a gap: ids above it move down
                    step = K.number_rows(ids, ["old"], name="new_id").withColumn("new_id", F.col("new_id") + F.lit(n))
                self.sizes[k] += row["n"]
            self.steps[k].append(step)

    def sources(self, tenants: Sequence[Tenant], tables: Sequence[str]) -> list[Tenant]:
        """``tenants`` (main, then subs) with ``tables`` as they are in main before the next sub, by the functions taken so far."""
        out = []
        behind: list[list[DataFrame | None]] = []
        for steps in self.steps:
            acc, own = None, []
            for j in range(len(steps) - 1, -1, -1):
                acc = then(steps[j], acc)
                own.append(acc)
            behind.append(own[::-1])
        for i, tenant in enumerate(tenants):
            cur = tenant.with_tables({}, drop=[t for t in tenant.names() if t not in set(tables)])
            for (group, texts), own in zip(self.groups, behind):
                if i < len(own):
                    cur = K.apply_group(cur, group, own[i], texts)
            out.append(cur)
        return out
