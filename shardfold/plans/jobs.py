"""Merge jobs (R1-R5): compositions of the operators, one per family of the
reference's per-game scripts.  Each returns the merged tenant (lazy
DataFrames); writing it is :func:`shardfold.sources.sinks.write_tenant`.

Several subs are applied in list order and each sees main as left by the
previous sub (H25).  Every sub's offsets (and conflict names N2, account
relink I1) read the main left by the previous sub: from tracked maxima and
name snapshots, while the merge itself is one pass per table over all subs.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..model import Tenant
from ..operators import identity as I
from ..operators import keys as K
from ..operators import merge as M
from ..operators import names as N
from ..operators import retention as R
from ..operators import rows as P
from ..session import cut_lineage
from .compose import Composition, composable
from .remap import remap, renumber_groups


@dataclass
class SubTenant:
    """One source database and its per-sub overrides of the rules."""

    tenant: Tenant
    server_id: object | None = None
    prefix: str | None = None
    account_suffix: str | None = None
    accounts: Tenant | None = None


@dataclass
class JobResult:
    main: Tenant
    accounts: Tenant | None = None
    actions: list[tuple[str, str, str]] = field(default_factory=list)  # (sub, table, action)
    ignored: list[str] = field(default_factory=list)
    extra: dict[str, object] = field(default_factory=dict)  # side outputs (login tenant, merge records, ...)


def _with_overrides(rules: Mapping, sub: SubTenant) -> dict:
    """A new rule dict with the sub's prefix/suffix (the shared one is never mutated, H9)."""
    r = copy.deepcopy(dict(rules))
    ps = dict(r.get("prefix_setting") or {})
    if sub.prefix is not None:
        ps["prefix"] = sub.prefix
    if sub.account_suffix is not None:
        ps["account_suffix"] = sub.account_suffix
    r["prefix_setting"] = ps
    return r


def apply_names(main: Tenant, sub: Tenant, rules: Mapping, main_accounts: Tenant | None = None,
                main_names: Mapping[tuple[str, str], DataFrame] | None = None) -> Tenant:
    """Role/guild affixes (N1/N2), account suffix (N3) and relink (I1) on the sub.

    ``main_names``: snapshots of main's name columns ``{(table, column): df}``
    (and user tables ``{(table, "*users"): df}``) to read instead of main's
    whole tables; see :func:`run_rules`.
    """
    main_names = main_names or {}
    ps = rules.get("prefix_setting") or {}
    side = "prefix" if str(ps.get("additional_string")) == "1" else "suffix"
    text = ps.get("prefix") or ""
    if str(ps.get("role_is")) in ("1", "2"):  # H17: "2" also affixes
        for item in ps.get("role_name") or []:
            t, c = item["db_table"], item["db_field"]
            if not sub.has(t):
                continue
            skip = item.get("not_equal", "")
            if str(ps.get("repeat_modify")) == "1" and main.has(t):
                names = main_names.get((t, c), main.table(t))
                sub = sub.replace(**{t: N.affix_conflicts(sub.table(t), names, c, text, side, skip)})
            else:
                sub = sub.replace(**{t: N.affix(sub.table(t), c, text, side, skip)})
    if str(ps.get("guild_is")) in ("1", "2"):
        for item in ps.get("guild_name") or []:
            t, c = item["db_table"], item["db_field"]
            if sub.has(t):
                sub = sub.replace(**{t: N.affix(sub.table(t), c, text, side, item.get("not_equal", ""))})
    acct = str(ps.get("account_change"))
    if acct in ("1", "2"):
        for item in ps.get("account_table") or []:
            t, c = item["db_table"], item["db_field"]
            if sub.has(t):
                sub = sub.replace(**{t: N.affix(sub.table(t), c, ps.get("account_suffix") or "", "suffix")})
    if acct == "999":
        confs = ps.get("account_change_new") or []
        users_src = main_accounts or main
        for i, conf in enumerate(confs):
            ut, uid, uname = conf["db_table_user"], conf["db_field_user_id"], conf["db_field_user_name"]
            pt, pfk = conf["db_table_player"], conf["db_field_player_user_id"]
            if not (sub.has(ut) and users_src.has(ut) and sub.has(pt)):
                continue
            main_users = users_src.table(ut) if main_accounts is not None else \
                main_names.get((ut, "*users"), users_src.table(ut))
            users, kids = I.relink_accounts(main_users, sub.table(ut), uid, uname, {pt: (sub.table(pt), pfk)})
            sub = sub.replace(**kids)
            if i == len(confs) - 1:  # duplicate sub users go after the last rule
                sub = sub.replace(**{ut: users})
    return sub


def apply_server_info(sub: Tenant, rules: Mapping, server_id) -> Tenant:
    """Stamp the server-id columns with the sub's own id."""
    si = rules.get("server_info") or {}
    if str(si.get("server_is")) != "1" or server_id is None:
        return sub
    out = {}
    for item in si.get("server_sql") or []:
        t = item["db_table"]
        if sub.has(t):
            out[t] = P.stamp_tenant(out.get(t, sub.table(t)), [item["db_field"]], server_id)
    return sub.with_tables(out)


def apply_declared_tables(t: Tenant, rules: Mapping) -> Tenant:
    """``empty_table`` (P9) and ``modify_table`` (P3): opt-in, off by default (H8)."""
    out = {}
    for item in rules.get("empty_table") or []:
        if t.has(item["db_table"]):
            out[item["db_table"]] = P.empty(t.table(item["db_table"]))
    for item in rules.get("modify_table") or []:
        tb = item["db_table"]
        if t.has(tb):
            df = out.get(tb, t.table(tb))
            out[tb] = P.set_where(df, F.col(item["db_field"]) == F.expr(str(item["conditions"])),
                                  {item["db_field"]: F.expr(str(item["results"]))})
    return t.with_tables(out)


def _materialise(t: Tenant, before: Tenant) -> Tenant:
    """``t`` with the tables that differ from ``before``'s checkpointed; the others are never copied."""
    return t.with_tables({n: cut_lineage(df) for n, df in t.tables.items() if df is not before.tables.get(n)})


def rule_columns(rules: Mapping, tenant: Tenant) -> list[tuple[str, str]]:
    """Every (table, column) whose maximum a rule document asks for (a group's first member only)."""
    cols = []
    for grp in rules.get("same") or []:
        cols += [(g["db_table"], g["db_field"]) for g in (grp.get("group") or [])[:1]]
    cols += [(i["db_table"], i["db_field"]) for i in rules.get("other_identity") or []]
    sp = rules.get("simple_process") or {}
    cols += [(d["db_table"], d["db_field"]) for d in sp.get("deal_with") or []]
    for p in sp.get("primary_key") or []:
        cols += [(t, p["db_field"]) for t in tenant.columns_named(p["db_field"])]
    return list(dict.fromkeys(c for c in cols if c[0] and c[1]))


def _renumbered(rules: Mapping) -> set[tuple[str, str]]:
    if str(rules.get("restructure_state")) != "1":
        return set()
    return {(g["db_table"], g["db_field"]) for tool in rules.get("restructure_tool") or []
            for g in tool.get("group") or []}


def _fold_known(prev: Tenant, merged: Tenant, sub: Tenant, rules: Mapping, exclude: set[str],
                cols: Sequence[tuple[str, str]], declared: bool = False,
                merged_tables: set[str] | None = None) -> Tenant:
    """Known maxima of main after one sub, where they follow exactly from main's and the sub's.

    A column that is its table's only key (clashing rows share the key
    value), or lives in a keyless table (plain append), has
    ``max(main, rewritten sub)``; an excluded table keeps main's.  Columns of
    a renumbered group, or any other column, are left unknown and scanned
    when next needed.
    """
    renum = _renumbered(rules)
    if declared:  # emptied or modified destination tables: values no longer follow
        renum |= {(t, c) for t, c in cols for item in (rules.get("empty_table") or []) + (rules.get("modify_table") or [])
                  if item.get("db_table") == t}
    wanted = [c for c in cols if c not in renum and c in prev.known_max and c[0] not in exclude]
    sub_max = K.max_ids([sub], wanted) if wanted else {}
    known = {}
    for t, c in cols:
        if (t, c) in renum or (t, c) not in prev.known_max:
            continue
        if t in exclude or not sub.has(t) or (merged_tables is not None and t not in merged_tables):
            known[(t, c)] = prev.known_max[(t, c)]  # main's table passed through unchanged
            continue
        keys = merged.spec(t).keys
        if not keys or keys == ((c,),):
            known[(t, c)] = max(prev.known_max[(t, c)], sub_max.get((t, c), 0))
    return merged.with_known_max(known)


def name_tables(rules: Mapping, main_accounts: Tenant | None) -> list[str]:
    """Main's tables that the name rules of the next sub read."""
    ps = rules.get("prefix_setting") or {}
    out = []
    if str(ps.get("repeat_modify")) == "1" and str(ps.get("role_is")) in ("1", "2"):
        out += [item["db_table"] for item in ps.get("role_name") or []]
    if str(ps.get("account_change")) == "999" and main_accounts is None:
        out += [conf["db_table_user"] for conf in ps.get("account_change_new") or []]
    return list(dict.fromkeys(out))


def _name_snapshots(merged: Tenant, rules: Mapping, main_accounts: Tenant | None) -> dict:
    """Checkpointed projections of main that the next sub's name rules read.

    Conflict-only affixes (N2) need main's distinct names; the account
    relink (I1) needs main's (id, name) user pairs when the users live in
    main.  These columns are all that is materialised between subs.
    """
    ps = rules.get("prefix_setting") or {}
    out = {}
    if str(ps.get("repeat_modify")) == "1" and str(ps.get("role_is")) in ("1", "2"):
        for item in ps.get("role_name") or []:
            t, c = item["db_table"], item["db_field"]
            if merged.has(t) and (t, c) not in out:
                out[(t, c)] = cut_lineage(merged.table(t).select(c).distinct())
    if str(ps.get("account_change")) == "999" and main_accounts is None:
        for conf in ps.get("account_change_new") or []:
            ut = conf["db_table_user"]
            if merged.has(ut) and (ut, "*users") not in out:
                out[(ut, "*users")] = cut_lineage(
                    merged.table(ut).select(conf["db_field_user_id"], conf["db_field_user_name"]))
    return out


def run_rules(main: Tenant, subs: Sequence[SubTenant], rules: Mapping, main_accounts: Tenant | None = None,
              declared_tables: bool = False, checkpoint_between: bool = False) -> JobResult:
    """R1 rule-driven merge: per sub remap -> names -> stamp, then one merge per table, and accounts.

    Several subs are applied in order, each against main as left by the
    previous one (H25), without materialising main between subs:

    * main's id maxima are tracked on the driver where they are exact (see
      :func:`_fold_known`), so a sub's offsets never re-run the merges
      before it: one small job per sub over the sub's own tables;
    * name rules that read main (conflict-only affixes N2, account relink
      I1) read checkpointed snapshots of just the name columns;
    * the rewritten subs are merged into main at the end, all subs of a table
      in one pass (:func:`shardfold.operators.merge.merge_all_table`), so a
      table's plan has the same shuffles for any number of subs.

    Renumbering (K5) rewrites main before every sub; its mappings are
    composed (:mod:`shardfold.plans.compose`) and each table is rewritten once
    at the end.  Declared tables, and groups whose ids can't be followed that
    way, are merged step by step; there the tables that a sub changed are
    checkpointed before the next one.  ``checkpoint_between=True`` does so for
    any rules.
    """
    res = JobResult(main, main_accounts)
    exclude = [i["db_table"] for i in rules.get("un_merge") or []]
    renumbers = bool(renumber_groups(rules))
    cols = rule_columns(rules, main) if len(subs) > 1 else []
    stepwise = checkpoint_between or declared_tables or renumbers and not composable(rules, main, [s.tenant for s in subs], cols)
    track = len(subs) > 1 and not stepwise
    composition = Composition(main, rules) if track and renumbers else None
    if track and cols:
        firsts = composition.known() if composition else {}
        res.main = main.with_known_max({**K.max_ids([main], [c for c in cols if c not in firsts]), **firsts})
    snapshots: dict = {}
    rewritten: list[tuple[Tenant, set[str]]] = []
    offsets: list[dict[tuple[str, str], int]] = []
    for k, s in enumerate(subs):
        r = _with_overrides(rules, s)
        rm = remap(res.main, s.tenant, r, renumber_main=composition is None)
        res.ignored.extend(rm.ignored)
        cur_main, sub = rm.main, rm.sub
        sub = apply_names(cur_main, sub, r, res.accounts, snapshots)
        # the sub's own id, else the rule document's default slave server id
        sub = apply_server_info(sub, r, s.server_id if s.server_id is not None else r.get("slave_server"))
        if declared_tables:
            cur_main, sub = apply_declared_tables(cur_main, r), apply_declared_tables(sub, r)
        # a modified table's keys need not be where the shift put them
        passed = {} if declared_tables else {c: off for c, off in rm.passed().items() if c not in rewritten_keys(r)}
        merged, actions = M.merge_tenant(cur_main, sub, exclude=exclude, shifted=passed)
        res.actions.extend((s.tenant.name, t, a) for t, a in actions)
        done = {t for t, a in actions if a == "merged"}
        rewritten.append((sub, done))
        offsets.append(passed)
        ps = r.get("prefix_setting") or {}
        if str(ps.get("account_change")) == "1" and res.accounts is not None and s.accounts is not None:
            # only a suffix of the sub's own is put on its accounts
            res.accounts = M.merge_accounts(res.accounts, s.accounts, s.account_suffix or "")
        if k < len(subs) - 1:
            if stepwise:
                merged = _materialise(merged, res.main)
            else:
                if cols:
                    merged = _fold_known(res.main, merged, sub, r, set(exclude), cols, declared_tables, done)
                named = merged
                if composition:
                    composition.take(sub, done)
                    merged = merged.with_known_max({**merged.known_max, **composition.known()})
                    tables = [t for t in name_tables(r, main_accounts) if t in done]
                    if tables:  # the rows, and so the names, that main has after this sub
                        named = merged.with_tables(_merged_tables(main, merged, rewritten, tables, composition))
                snapshots = _name_snapshots(named, r, main_accounts)
        res.main = merged
    if track:
        tables = {t for _, done in rewritten for t in done}
        if composition:  # also what no sub has, but main's own numbering changed
            tables |= {t for group, texts in composition.groups for t, *_ in [*group, *texts] if main.has(t)}
        res.main = res.main.with_tables(_merged_tables(main, res.main, rewritten, sorted(tables), composition, offsets))
    return res


def rewritten_keys(rules: Mapping) -> set[tuple[str, str]]:
    """Columns that name, account and server rules may write after the shift."""
    ps, si = rules.get("prefix_setting") or {}, rules.get("server_info") or {}
    items = [*(ps.get("role_name") or []), *(ps.get("guild_name") or []), *(ps.get("account_table") or []), *(si.get("server_sql") or [])]
    out = {(i["db_table"], i["db_field"]) for i in items}
    return out | {(c["db_table_player"], c["db_field_player_user_id"]) for c in ps.get("account_change_new") or []}


def _merged_tables(main: Tenant, typed: Tenant, rewritten: Sequence[tuple[Tenant, set[str]]], tables: Sequence[str],
                   composition: Composition | None, offsets: Sequence[Mapping[tuple[str, str], int]] = ()) -> dict[str, DataFrame]:
    """``tables`` of main and all rewritten subs so far in one merge each, with ``typed``'s (widened) column types.

    ``offsets`` of the subs' shifted columns: where every sub's only key was
    shifted, main's rows below the least offset go around the merge.
    """
    base = main.with_tables({t: M.align(main.table(t), typed.table(t)) for t in tables})
    sources = [base, *[sub for sub, _ in rewritten]]
    if composition:
        sources = composition.sources(sources, tables)
    out = {}
    for t in tables:
        subs = [new for new, (_, done) in zip(sources[1:], rewritten) if t in done]
        keys = main.spec(t).keys or (subs[0].spec(t).keys if subs else ())
        top = sources[0].table(t)
        passed = [off for off, (_, done) in zip(offsets, rewritten) if t in done]
        key = keys[0][0] if len(keys) == 1 and len(keys[0]) == 1 else None
        upto = min((off.get((t, key), 0) for off in passed), default=0) if passed and not composition else 0
        if upto > 0:
            clear, top = M.split_by_range(top, key, upto)
        out[t] = M.merge_all_table([top, *[s.table(t) for s in subs]], keys)
        if upto > 0:
            out[t] = clear.unionByName(out[t])
    return out


def exclusion_merge(main: Tenant, subs: Sequence[Tenant], exclude: Iterable[str] = (),
                    on_missing: str = "skip") -> JobResult:
    """R2: every table but ``exclude``, subs in order (M6/M7).

    All subs go in one many-tenant merge (one shuffle per table whatever the
    number of subs, the last sub wins per key) instead of one chained
    anti join per sub.
    """
    exclude = set(exclude)
    res = JobResult(M.merge_all(main, subs, exclude=exclude, on_missing=on_missing))
    for s in subs:
        for t in s.names():
            action = "excluded" if t in exclude else "merged" if main.has(t) else \
                ("copied" if on_missing == "copy" else "missing")
            if action == "missing" and on_missing == "error":
                raise KeyError(f"main tenant {main.name!r} has no table {t!r}")
            res.actions.append((s.name, t, action))
    return res


def filtered_merge(main: Tenant, subs: Sequence[Tenant], filters: Mapping[str, object],
                   mode: str = "replace") -> JobResult:
    """Only the listed tables, each with its row filter (M5).

    The filters do not read main, so in ``replace`` mode all subs of a table
    go in one many-tenant merge (one shuffle whatever the number of subs).
    """
    res = JobResult(main)
    out = {}
    for t, pred in filters.items():
        if not main.has(t):
            res.actions.extend((s.name, t, "missing") for s in subs if s.has(t))
            continue
        no_filter = pred is None or (isinstance(pred, str) and not pred.strip())
        frames = [s.table(t) if no_filter else s.table(t).where(as_column(pred)) for s in subs if s.has(t)]
        res.actions.extend((s.name, t, "merged") for s in subs if s.has(t))
        if not frames:
            continue
        if mode == "replace":
            out[t] = M.merge_all_table([main.table(t)] + frames, main.spec(t).keys) if main.spec(t).keys \
                else M._union_all([main.table(t)] + frames)
        else:
            acc = main.table(t)
            for f in frames:
                acc = M.merge_filtered(acc, f, main.spec(t).keys, F.lit(True), mode)
            out[t] = acc if mode != "absent" else M.merge_absent_all(main.table(t), frames, main.spec(t).keys)
    res.main = main.with_tables(out)
    return res


def relabel_merge(main: Tenant, subs: Sequence[Tenant], exclude: Iterable[str] = (),
                  name_cols: Sequence[tuple[str, str]] = (), zone_cols: Sequence[tuple[str, str]] = (),
                  prefix_template: str = "s{zone}", relabel: str = "map", stamp: str = "main",
                  login: tuple[Tenant, str, str] | None = None, merge_record: bool = False,
                  server_config: tuple[Tenant, str, Mapping[str, object]] | None = None) -> JobResult:
    """Relabel each sub, then merge all but ``exclude`` (M6/M7).

    * names: prefixed with ``s<zone>`` (N4);
    * zone columns: ``relabel="map"`` sets ``c = main zone WHERE c = sub zone``
      (P3); ``"stamp"`` sets every row to main's (``stamp="main"``) or the
      sub's own zone (``"sub"``, H22) (P4);
    * ``login=(tenant, table, column)``: that other database's server column
      is re-pointed from every sub zone to main's (P3), returned as
      ``extra["login"]``;
    * ``merge_record``: one row ``(platform, fromServerId, toServerId,
      finalServerId)`` per sub in ``extra["t_merge_record"]`` (S8);
    * ``server_config=(tenant, table, values)``: ``SET values WHERE
      serverType = 0 AND serverId = <sub zone>`` (P2), in ``extra["server_config"]``.

    The rewrites do not read main, so all subs go in one many-tenant merge
    per table.
    """
    relabeled = []
    for s in subs:
        out = {}
        for t, c in name_cols:
            if s.has(t):
                out[t] = N.tenant_prefix(out.get(t, s.table(t)), c, s.zone, prefix_template)
        for t, c in zone_cols:
            if s.has(t):
                df = out.get(t, s.table(t))
                if relabel == "map":
                    out[t] = P.map_values(df, c, {s.zone: main.zone})
                else:
                    out[t] = P.stamp_tenant(df, [c], main.zone if stamp == "main" else s.zone)
        relabeled.append(s.with_tables(out))
    res = exclusion_merge(main, relabeled, exclude=exclude)
    spark = next(iter(main.tables.values())).sparkSession if main.tables else None
    if login is not None:
        lt, table, col = login
        df = lt.table(table)
        for s in subs:
            df = P.map_values(df, col, {s.zone: main.zone})
        res.extra["login"] = lt.replace(**{table: df})
    if merge_record and spark is not None:
        res.extra["t_merge_record"] = spark.createDataFrame(
            [(1, s.zone, main.zone, main.zone) for s in subs],
            "platform int, fromServerId int, toServerId int, finalServerId int")
    if server_config is not None:
        ct, table, values = server_config
        df = ct.table(table)
        for s in subs:
            df = P.set_where(df, (F.col("serverType") == 0) & (F.col("serverId") == s.zone), dict(values))
        res.extra["server_config"] = ct.replace(**{table: df})
    return res


#: fixed values: the tables that the append-and-reconcile job appends, and how
APPEND_RECONCILE_TABLES = {
    **dict.fromkeys(("t_account", "t_active_task"), {"mode": "error"}),
    "t_activity_op": {"mode": "empty"},
    **dict.fromkeys((
        "t_activity_op_task", "t_activity_op_task_new", "t_charge_record", "t_counter", "t_dungeon", "t_g_dungeon_hard",
        "t_account_adventure", "t_account_monopoly", "t_hire", "t_guild", "t_guild_member", "t_item"), {"mode": "error"}),
    "t_jar_record": {"mode": "empty"},
    **dict.fromkeys((
        "t_jaritem_pool", "t_mail", "t_mailitem", "t_mall_gift_pack", "t_offline_event", "t_pk_statistic", "t_player_info",
        "t_punishment", "t_red_packet", "t_red_packet_receiver", "t_relation", "t_retinue", "t_shop", "t_shopitem",
        "t_sortlist", "t_sys_record", "t_task", "t_auction_new", "t_pet", "t_guild_storage", "t_guildstorage_oprecord",
        "t_questionnaire", "t_mastersect_relation", "t_account_shop_role_buy_record", "t_auction_transaction",
        "t_activity_op_attribute", "t_mall_item", "t_blackmarket_auction", "t_blackmarket_transaction", "t_expedition_map",
        "t_expedition_member", "t_head_frame", "t_item_deposit", "t_week_sign", "t_activity_account_record",
        "t_activity_op_account_task", "t_activity_op_record", "t_account_task", "t_new_title_accout", "t_new_title",
        "t_team_copy", "t_currency_frozen", "t_honor_role", "t_honor_history", "t_shortcut_key", "t_credit_point_record"),
        {"mode": "error"}),
    "t_player_info_name": {"mode": "absent", "keys": ["name"]},
    "t_abnormal_transaction": {"mode": "surrogate", "keys": ["guid"]},
    "t_account_counter": {"mode": "error", "where": "counter_type IN (1, 2, 3, 4, 5, 6, 10)"},
    "t_account_shop_acc_buy_record": {"mode": "error", "where": "shop_id IN (51, 52, 70, 34)"},
}


def _append_table(main_df: DataFrame, main_zone: int, subs: Sequence[tuple[Tenant, DataFrame]], keys,
                  how: Mapping, zone_col: str | None) -> DataFrame:
    mode = how.get("mode", "error")
    keys = [tuple(how["keys"])] if how.get("keys") else keys  # keys of the mode itself go before declared ones
    acc = main_df if zone_col is None else P.with_zone(main_df, main_zone, zone_col)
    if mode == "empty":  # the destination is cleared and nothing is appended
        return P.empty(acc)
    prepared = []
    for s, src in subs:
        if how.get("where") is not None:
            src = src.where(how["where"])
        if zone_col is not None:
            src = P.with_zone(src, s.zone, zone_col)
        prepared.append(src)
    if mode == "error":  # one clash check for every sub, then one union
        return M.merge_append_all(acc, prepared, keys)
    if mode == "absent":  # the first source that holds a key keeps it
        return M.merge_absent_all(acc, prepared, keys)
    for src in prepared:
        acc = M.append_new_surrogate(acc, src, keys[0][0]) if mode == "surrogate" else M.merge_append(acc, src, keys, on_conflict=mode)
    return acc


def append_reconcile(main: Tenant, subs: Sequence[Tenant], spec: Mapping, zone_col: str = "zone_id") -> JobResult:
    """R5 append every sub, then reconcile identities once.

    ``spec`` keys (all optional):

    * ``append``: table -> mode (``"error"`` default | ``"replace"`` | ``"ignore"``)
      or ``{"mode": …, "where": predicate}`` with modes ``error``, ``replace``,
      ``ignore``, ``absent`` (insert if the key is absent), ``surrogate``
      (new primary key after main's max, S6) and ``empty`` (main's table
      cleared, nothing appended); see :data:`APPEND_RECONCILE_TABLES`;
    * ``append_rest``: also append every other table main and a sub share;
    * ``names``: ``[{table, name, id, cascade: [(table, on_col, name_col)], ledger_type}]`` (N5-N7);
    * ``accounts``: ``{table, key, id, order, folds, repoint: [(table, set_col, on_col)]}`` (I2, I3, I8);
    * ``resets``: per-table reset steps (I17), e.g. ``APPEND_RECONCILE_RESETS``;
    * ``final_zone``: ``[(table, column)]`` stamped with main's zone (I18).

    A ``zone_col`` lineage column (the tenant a row came from) is added to
    appended tables on both sides and dropped at the end.  The compensation
    ledger is returned as the ``ledger`` table.
    """
    main_zone = main.zone
    tables = {t: ({"mode": h} if isinstance(h, str) or h is None else dict(h))
              for t, h in (spec.get("append") or {}).items()}
    if spec.get("append_rest"):
        for t in main.names():
            if t not in tables and any(s.has(t) for s in subs):
                tables[t] = {"mode": "error"}
    out = {}
    for t, how in tables.items():
        if not main.has(t):
            continue
        srcs = [(s, s.table(t)) for s in subs if s.has(t)]
        out[t] = _append_table(main.table(t), main_zone, srcs, main.spec(t).keys, how, zone_col)
    cur = main.with_tables(out)
    ledgers = []
    for nm in spec.get("names") or []:
        t = nm["table"]
        renamed, renames = N.rename_duplicates(cur.table(t), nm["name"], zone_col, main_zone, id_col=nm["id"])
        renames = cut_lineage(renames)  # reused by every cascade and the ledger
        upd = {t: renamed}
        for ct, on_col, name_col in nm.get("cascade") or []:
            if cur.has(ct):
                upd[ct] = N.cascade(upd.get(ct, cur.table(ct)), on_col, name_col, renames)
        cur = cur.with_tables(upd)
        ledgers.append(N.rename_ledger(renames, int(nm.get("ledger_type", 1))))
    acc = spec.get("accounts")
    if acc:
        t = acc["table"]
        folded = I.fold(cur.table(t), acc["key"], acc.get("order") or [acc["id"]], acc.get("folds") or {},
                        prefer=F.col(zone_col) == F.lit(main_zone))
        folded = cut_lineage(folded)
        keep = I.keep_map(folded, acc["key"], acc["id"])
        upd = {t: folded}
        for ct, set_col, on_col in acc.get("repoint") or []:
            if cur.has(ct):
                upd[ct] = I.repoint(cur.table(ct), set_col, on_col, keep)
        cur = cur.with_tables(upd)
    if spec.get("resets"):
        cur = R.reset(cur, spec["resets"])
    final = {}
    for t, c in spec.get("final_zone") or []:
        if cur.has(t):
            final[t] = R.final_zone(final.get(t, cur.table(t)), [c], main_zone, drop=())
    cur = cur.with_tables(final)
    cur = cur.with_tables({t: cur.table(t).drop(zone_col) for t in out})
    if ledgers:
        led = ledgers[0]
        for l in ledgers[1:]:
            led = led.unionByName(l)
        cur = cur.with_tables({"ledger": led})
    return JobResult(cur)
