"""Sinks (S7, S8): write a merged tenant to a new versioned folder and report
per-table row counts.

The reference updates the destination in place with no transaction (H20);
here every table of the result goes to ``<out>/v=<version>/<table>`` and a
``_PUBLISHED`` marker is written last, so a failed run never leaves a
half-merged destination and a path is never overwritten while it is read.
Rows written are counted by ``DataFrame.observe`` on the write itself;
:func:`merge_report` counts its inputs by a job of its own.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import Tenant


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write one table, returning its row count observed during the write."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return int(obs.get["rows"])


class TablesFailed(RuntimeError):
    """Some tables failed while they were written; ``failed`` tells which and why.  The others are written."""

    def __init__(self, version: str, failed: Mapping[str, str]):
        super().__init__(f"version {version} is not published, tables failed: {dict(failed)}")
        self.failed = dict(failed)


def manifest(spark: SparkSession, out: str, version: str) -> dict[str, dict]:
    """The latest entry of each table of a version: ``{table: {"status": "written" | "failed", "rows": n, "error": text}}``."""
    from .catalog import path_exists

    base = f"{out.rstrip('/')}/v={version}/_manifest"
    if not path_exists(spark, base):
        return {}
    rows = spark.read.schema(_ENTRY).json(base).groupBy("table").agg(F.max_by(F.struct("status", "rows", "error"), "at").alias("e"))
    return {r["table"]: r["e"].asDict() for r in rows.collect()}  # one row per table


_ENTRY = "table string, status string, rows bigint, error string, at double"


def write_tenant(tenant: Tenant, out: str, version: str, threads: int = 4, tables: Iterable[str] | None = None,
                 publish: str = "complete") -> dict[str, int]:
    """Write every table (independent jobs, a few at a time) then publish.

    Returns ``{table: rows_written}``.  ``out`` is a shared folder (HDFS/S3/…)
    on a cluster.  Each table that is done adds an entry to the version's
    manifest; one that fails while it runs does too, and the rest goes on.
    With failures nothing is published and :class:`TablesFailed` is raised,
    unless ``publish="partial"`` publishes what is there.  A rerun of an
    unpublished version writes the tables without a ``written`` entry
    and reads no other; a published version can't be written again.
    """
    from .catalog import path_exists

    if publish not in ("complete", "partial"):
        raise ValueError(f"publish must be complete|partial, not {publish!r}")
    base = f"{out.rstrip('/')}/v={version}"
    names = list(tables) if tables is not None else tenant.names()
    if not tenant.tables:
        return {}
    spark = next(iter(tenant.tables.values())).sparkSession
    if path_exists(spark, f"{base}/_PUBLISHED"):
        raise FileExistsError(f"version {version} under {out} is already published")
    done = {t: e["rows"] for t, e in manifest(spark, out, version).items() if e["status"] == "written"}

    def note(table: str, status: str, rows: int | None = None, error: str | None = None) -> None:
        entry = spark.createDataFrame([(table, status, rows, error, time.time())], _ENTRY)
        entry.coalesce(1).write.mode("append").json(f"{base}/_manifest")

    def one(table: str) -> tuple[str, int | None, str | None]:
        if table in done:
            return table, done[table], None
        try:
            n = write_table(tenant.table(table), f"{base}/{table}", "overwrite")  # what a failed run left
        except Exception as e:  # noqa: BLE001  whatever a table's own data or plan raises is that table's failure
            logging.getLogger(__name__).warning("table %s not written: %s", table, e)
            return table, None, str(e).split("\n")[0][:500]
        return table, n, None

    counts, failed = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for work in as_completed([pool.submit(one, t) for t in names]):
            table, n, error = work.result()
            if error is None:
                counts[table] = n
                if table not in done:
                    note(table, "written", n)
            else:
                failed[table] = error
                note(table, "failed", error=error)
    if failed and publish != "partial":
        raise TablesFailed(version, failed)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").text(f"{base}/_PUBLISHED")
    return {t: counts[t] for t in names if t in counts}


def save_bucketed(tenant: Tenant, database: str, buckets: int, tables: Iterable[str] | None = None,
                  mode: str = "errorifexists") -> dict[str, str]:
    """Store each keyed table bucketed and sorted by its primary key.

    When main and every sub are stored with the same bucket count, merges on
    the key (anti join + union) and the many-tenant window read co-located
    buckets: no shuffle of either side.  Keyless tables are stored as they
    are.  Returns ``{table: qualified name}``.
    """
    spark = next(iter(tenant.tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for t in (list(tables) if tables is not None else tenant.names()):
        name = f"{database}.{t}"
        w = tenant.table(t).write.mode(mode).format("parquet")
        key = list(tenant.spec(t).primary)
        if key:
            w = w.bucketBy(buckets, *key).sortBy(*key)
        w.saveAsTable(name)
        out[t] = name
    return out


def read_published(spark: SparkSession, out: str, version: str, name: str, zone: int,
                   tables: Iterable[str]) -> Tenant:
    """Re-open a published version as a tenant (fails if it was never published)."""
    from .catalog import path_exists

    base = f"{out.rstrip('/')}/v={version}"
    if not path_exists(spark, f"{base}/_PUBLISHED"):
        raise FileNotFoundError(f"version {version} under {out} is not published")
    return Tenant(name, zone, {t: spark.read.parquet(f"{base}/{t}") for t in tables})


def merge_report(main: Tenant, sub: Tenant, merged: Tenant, actions: Iterable[tuple[str, str]]) -> DataFrame:
    """S8 report ``(tenant, table_name, action, main_rows, sub_rows, out_rows, rows_replaced)`` of one merged sub.

    ``rows_replaced`` is how many of main's rows the incoming ones displaced.
    Every count is a global aggregate (partial counts per task); they are
    unioned and pivoted by one small grouped aggregate, so the whole report is
    one job.  A table is counted once, however many actions name it.
    """
    parts = []
    for name, action in dict(actions).items():
        for side, t in (("main", main), ("sub", sub), ("out", merged)):
            if t.has(name):
                parts.append(t.table(name).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
                    F.lit(name).alias("table_name"), F.lit(action).alias("action"),
                    F.lit(side).alias("side"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    wide = out.groupBy("table_name", "action").agg(*[
        F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).cast("bigint").alias(f"{s}_rows")
        for s in ("main", "sub", "out")])
    replaced = F.when(F.col("action") == "merged", F.col("main_rows") + F.col("sub_rows") - F.col("out_rows")).otherwise(F.lit(0))
    return wide.select(F.lit(sub.name).alias("tenant"), "*", replaced.cast("bigint").alias("rows_replaced"))


def action_summary(spark: SparkSession, actions: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Per sub: tables merged (also appended, copied, emptied), skipped (excluded, missing, not listed), failed and total.

    Notes on columns ("no column x") aren't tables and aren't counted.
    """
    rows = [(str(sub), str(t), str(a)) for sub, t, a in actions if not str(a).startswith("no column ")]
    df = spark.createDataFrame(rows, "sub string, table_name string, action string")
    return df.groupBy("sub").agg(
        F.count(F.when(F.col("action").isin("merged", "appended", "copied", "emptied"), 1)).alias("merged"),
        F.count(F.when(F.col("action").isin("excluded", "missing", "not listed"), 1)).alias("skipped"),
        F.count(F.when(F.col("action") == "failed", 1)).alias("failed"),
        F.count(F.lit(1)).alias("total"))


def lineage_rows(spark: SparkSession, records: Iterable[Mapping[str, object]]) -> DataFrame:
    """One merge record per merged sub ``(from_tenant, to_tenant, zone)``."""
    rows = [(str(r["from_tenant"]), str(r["to_tenant"]), int(r["zone"])) for r in records]
    return spark.createDataFrame(rows, "from_tenant string, to_tenant string, zone int")
