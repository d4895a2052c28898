"""Command-line entry: run a merge job over parquet tenants and publish it.

    python -m shardfold.plans.run --rules rules.json --main /data/s1 --main-zone 1 \
        --sub /data/s2:2 --sub /data/s3:3:s3.:_s3 --keys players=dbid --keys guild=dbid \
        --out /data/merged --version 2026-12-02

``--job``: ``rules`` (default, R1, needs ``--rules``), ``exclusion`` (R2,
``--exclude t``), ``filtered`` (R3, ``--filter table=predicate``), ``relabel``
(R4, ``--name-col table.col``, ``--zone-col table.col``, ``--exclude``) or
``reconcile`` (R5 account/player/guild preset, ``--zone``, ``--purge-as-of``).  ``--sub`` is
``path:zone[:prefix[:account_suffix]]`` and may repeat (applied in order);
``--keys`` declares a table's unique key (``table=col[,col]``; tables
without keys are appended).  A rule file is a JSON rule document (its
``script`` object, or the document itself).  Nothing is interactive; the
merged tenant is written as a new version and published last.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from ..session import ensure_checkpoint_dir
from ..sources.catalog import parquet_tenant
from ..sources.sinks import write_tenant
from . import jobs as J
from .jobs import SubTenant, run_rules


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="shardfold-run", description=__doc__.split("\n\n")[0])
    p.add_argument("--job", default="rules", choices=["rules", "exclusion", "filtered", "relabel", "reconcile"])
    p.add_argument("--rules", help="JSON rule document (job rules)")
    p.add_argument("--exclude", action="append", default=[], help="table left out of the merge")
    p.add_argument("--filter", action="append", default=[], help="table=predicate (job filtered)")
    p.add_argument("--name-col", action="append", default=[], help="table.column prefixed s<zone> (job relabel)")
    p.add_argument("--zone-col", action="append", default=[], help="table.column re-labelled (job relabel)")
    p.add_argument("--main", required=True, help="folder of the main tenant's parquet tables")
    p.add_argument("--main-zone", type=int, default=1)
    p.add_argument("--sub", action="append", required=True, help="path:zone[:prefix[:account_suffix]]")
    p.add_argument("--keys", action="append", default=[], help="table=col[,col]")
    p.add_argument("--out", required=True, help="output folder (a shared folder on a cluster)")
    p.add_argument("--version", required=True, help="version name under --out; an unpublished one is taken up where it stopped")
    p.add_argument("--publish", default="complete", choices=["complete", "partial"], help="partial: publish although tables failed")
    p.add_argument("--zone", type=int, help="zone that the merged tenant becomes (job reconcile; default main's)")
    p.add_argument("--purge-as-of", help="purge inactive players as of this UTC time, YYYY-MM-DD[THH:MM:SS] (job reconcile)")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> dict[str, int]:
    args = parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("shardfold-run").getOrCreate()
    ensure_checkpoint_dir(spark)
    specs = {}
    for k in args.keys:
        table, cols = k.split("=", 1)
        specs[table] = [c for c in cols.split(",") if c]
    main_t = parquet_tenant(spark, "main", args.main_zone, args.main, specs=specs)
    subs = []
    for i, spec in enumerate(args.sub):
        parts = spec.split(":")
        path, zone = parts[0], int(parts[1])
        prefix = parts[2] if len(parts) > 2 and parts[2] else None
        suffix = parts[3] if len(parts) > 3 and parts[3] else None
        subs.append(SubTenant(parquet_tenant(spark, f"sub{i + 1}", zone, path, specs=specs),
                              server_id=zone, prefix=prefix, account_suffix=suffix))
    tenants = [s.tenant for s in subs]
    if args.job == "rules":
        if not args.rules:
            raise SystemExit("--rules is required for --job rules")
        with open(args.rules, encoding="utf-8") as fh:
            doc = json.load(fh)
        res = run_rules(main_t, subs, doc.get("script", doc))
    elif args.job == "exclusion":
        res = J.exclusion_merge(main_t, tenants, exclude=args.exclude)
    elif args.job == "filtered":
        res = J.filtered_merge(main_t, tenants, dict(f.split("=", 1) for f in args.filter))
    elif args.job == "relabel":
        split = lambda items: [tuple(i.split(".", 1)) for i in items]
        res = J.relabel_merge(main_t, tenants, exclude=args.exclude, name_cols=split(args.name_col),
                              zone_cols=split(args.zone_col))
    else:
        from .reconcile import reconcile
        as_of = datetime.fromisoformat(args.purge_as_of) if args.purge_as_of else None
        res = reconcile(main_t, tenants, zid=args.zone, purge_as_of=as_of)
    failed = [(sub, table) for sub, table, action in res.actions if action == "failed"]
    if failed:
        raise SystemExit(f"not published, these tables could not be merged: {failed}")
    counts = write_tenant(res.main, args.out, args.version, publish=args.publish)
    for sub, table, action in res.actions:
        if action != "merged":
            print(f"{sub}: {table} {action}", file=sys.stderr)
    return counts


if __name__ == "__main__":
    print(json.dumps(main()))
