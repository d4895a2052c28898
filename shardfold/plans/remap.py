"""Rule-driven remapping (K10): rule types 1, 2 and 3 over a main/sub pair.

A rule document is a plain dict shaped like the reference's rule files
(``type``, ``same``, ``other_identity``, ``special_option``,
``simple_process``, ``restructure_*`` ...).  It is never mutated (H9).
Offsets are computed by small aggregate jobs (one per stage that needs
them); every rewrite is a lazy projection or a join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from ..model import Tenant
from ..operators import keys as K

Col = tuple[str, str]


@dataclass
class RemapResult:
    sub: Tenant
    main: Tenant
    group_offsets: list[int] = field(default_factory=list)
    other_offsets: list[int] = field(default_factory=list)
    shifted: dict[Col, int] = field(default_factory=dict)
    ignored: list[str] = field(default_factory=list)
    touched: set[Col] = field(default_factory=set)  # changed again after the shift

    def passed(self) -> dict[Col, int]:
        """Shifted columns whose positive values all lie above the offset."""
        return {c: off for c, off in self.shifted.items() if c not in self.touched and off > 0}


def _on(value) -> bool:
    return str(value) == "1"


def _pick(offsets: list[int], idx: int, what: str) -> int:
    if idx < 1 or idx > len(offsets):
        raise IndexError(f"rule index {idx} out of range for {what} ({len(offsets)} entries)")  # H18
    return offsets[idx - 1]


def _widen_cols(t: Tenant, cols) -> Tenant:
    from ..operators.rows import widen
    per = {}
    for tb, c in cols:
        if t.has(tb) and c in t.table(tb).columns and c not in per.get(tb, ()):
            per.setdefault(tb, []).append(c)
    return t.with_tables({tb: widen(t.table(tb), cs) for tb, cs in per.items()})


def remap_type1(main: Tenant, sub: Tenant, rules: Mapping) -> RemapResult:
    """Type 1: K4 over ``other_identity`` only."""
    cols = [(i["db_table"], i["db_field"]) for i in rules.get("other_identity") or []]
    new_sub, offs = K.shift_each(main, sub, cols)
    return RemapResult(new_sub, main, other_offsets=[offs[c] for c in cols], shifted=dict(offs))


def renumber_groups(rules: Mapping) -> list[tuple[list[tuple], list[K.Text]]]:
    """The declared K5 groups: members ``(table, column, condition)`` and the text columns that write a member's ids (H7)."""
    if not _on(rules.get("restructure_state")):
        return []
    opt = rules.get("special_option") or {}
    texts = (opt.get("teshudb_field") or []) if _on(opt.get("teshudb_field_open")) else []
    out = []
    for tool in rules.get("restructure_tool") or []:
        grp = [(g["db_table"], g["db_field"], g.get("conditions") or None) for g in tool.get("group") or []]
        grp = [g for g in grp if g[0] and g[1]]
        ids = {g[:2] for g in grp}
        own = [(x["db_table"], x["db_field"], x.get("delimiter", ",")) for x in texts
               if (x.get("db_table_attribution"), x.get("db_field_attribution")) in ids]
        if grp:
            out.append((grp, list(dict.fromkeys(own))))
    return out


def remap_type2(main: Tenant, sub: Tenant, rules: Mapping, renumber_main: bool = True) -> RemapResult:
    """Type 2: K5 (both sides) -> K3 -> K4 -> K6 -> K7.

    Ids inside text follow the renumbering of the ids they name, then the
    shift.  ``renumber_main=False`` leaves main's tables as they are: the
    caller composes main's mappings and knows its maxima.
    """
    res = RemapResult(sub, main)
    for grp, texts in renumber_groups(rules):
        if renumber_main:  # main and sub each renumbered 1..n, in one numbering pass
            res.main, res.sub = K.renumber_many([res.main, res.sub], grp, texts=texts)
        else:
            res.sub = K.renumber_many([res.sub], grp, texts=texts)[0]
    original_sub = res.sub
    groups = [[(g["db_table"], g["db_field"]) for g in grp.get("group") or []] for grp in rules.get("same") or []]
    groups = [g for g in groups if g]
    widen_on = _on((rules.get("simple_process") or {}).get("character_types"))
    if groups:
        firsts = [g[0] for g in groups]
        maxes = K.max_ids([res.main, res.sub], firsts)
        plan: dict[Col, int] = {}
        for g in groups:
            off = maxes[g[0]]
            res.group_offsets.append(off)
            if widen_on:
                res.main, res.sub = _widen_cols(res.main, g), _widen_cols(res.sub, g)
            for m in g:
                plan.setdefault(m, off)
        res.sub = K.shift_columns(res.sub, plan)
        res.shifted.update(plan)
    others = [(i["db_table"], i["db_field"]) for i in rules.get("other_identity") or []]
    if others:
        offs = K.max_ids([res.main, res.sub], others)  # after K3, as in the reference
        res.other_offsets = [offs[c] for c in others]
        res.sub = K.shift_columns(res.sub, {c: offs[c] for c in others if c not in res.shifted})
        res.shifted.update({c: offs[c] for c in others if c not in res.shifted})
    opt = rules.get("special_option") or {}
    if _on(opt.get("special_field_open")):
        for item in opt.get("special_field") or []:
            idx = int(item.get("type") or 0)
            if idx <= 0:
                continue
            off = _pick(res.group_offsets if str(item.get("group")) == "1" else res.other_offsets, idx,
                        "same" if str(item.get("group")) == "1" else "other_identity")
            t = item["db_table"]
            res.touched.add((t, item["db_field"]))
            if res.sub.has(t):
                res.sub = res.sub.replace(**{t: K.shift_when(res.sub.table(t), item["db_field"], off,
                                                             item.get("conditions") or None)})
    if _on(opt.get("teshudb_field_open")):
        for item in opt.get("teshudb_field") or []:
            idx = int(item.get("type") or 0)
            if idx <= 0:
                continue
            off = _pick(res.group_offsets if str(item.get("group")) == "1" else res.other_offsets, idx,
                        "same" if str(item.get("group")) == "1" else "other_identity")
            t, at = item["db_table"], item["db_table_attribution"]
            if res.sub.has(t) and original_sub.has(at):
                valid = original_sub.table(at).select(item["db_field_attribution"])
                key = res.sub.spec(t).primary or None
                res.sub = res.sub.replace(**{t: K.shift_tokens(res.sub.table(t), item["db_field"], off,
                                                               item.get("delimiter", ","), valid, key)})
    if (rules.get("simple_process") or {}).get("deal_with"):
        res.ignored.append("simple_process.deal_with")  # H23
    return res


def remap_type3(main: Tenant, sub: Tenant, rules: Mapping) -> RemapResult:
    """Type 3: K8 ``deal_with`` then K9 ``primary_key`` (each column shifted once, H4)."""
    sp = rules.get("simple_process") or {}
    res = RemapResult(sub, main)
    deal = [d for d in sp.get("deal_with") or [] if d.get("db_table") and d.get("db_field")]
    widen_on = _on(sp.get("character_types"))  # widen before shifting: a shifted id may not fit the old type
    if deal:
        if widen_on:
            cols = [c for d in deal for c in K.associated_columns(sub, d)]
            res.main, res.sub = _widen_cols(res.main, cols), _widen_cols(res.sub, cols)
        res.sub, plan = K.shift_associated(res.main, res.sub, deal)
        res.shifted.update(plan)
    names = [p["db_field"] for p in sp.get("primary_key") or [] if p.get("db_field")]
    if names:
        if widen_on:
            cols = [(t, n) for n in names for t in res.sub.columns_named(n) if (t, n) not in res.shifted]
            res.main, res.sub = _widen_cols(res.main, cols), _widen_cols(res.sub, cols)
        res.sub, offs = K.shift_by_column_name(res.main, res.sub, names, done=res.shifted)
        res.shifted.update(offs)
    if (rules.get("special_option") or {}).get("teshudb_field"):
        res.ignored.append("special_option.teshudb_field")  # H23
    return res


def remap(main: Tenant, sub: Tenant, rules: Mapping, renumber_main: bool = True) -> RemapResult:
    """K10 dispatch on ``rules["type"]``; an unknown type raises."""
    kind = str(rules.get("type"))
    if kind == "1":
        return remap_type1(main, sub, rules)
    if kind == "2":
        return remap_type2(main, sub, rules, renumber_main)
    if kind == "3":
        return remap_type3(main, sub, rules)
    raise ValueError(f"unknown rule type {rules.get('type')!r}")
