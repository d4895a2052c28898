"""Tenant sources (S1-S5): parquet folders, catalog databases and JDBC schemas.

Tables are read lazily; nothing is scanned until a job runs, so unused
columns and excluded tables are never read (column pruning and filter
pushdown reach the parquet scan).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..model import Tenant


def has_column(df: DataFrame, c: str) -> bool:
    """S4 column probe (schema only, no job)."""
    return c in df.columns


def _fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem of ``path`` (local, HDFS, object store alike) and its Path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_parquet_tables(spark: SparkSession, path: str) -> list[str]:
    """S3 for a folder: every ``<name>.parquet`` file or folder, or plain folder, is a table."""
    fs, p = _fs(spark, path)
    out = []
    for st in fs.listStatus(p):
        entry = st.getPath().getName()
        if entry.startswith(("_", ".")):
            continue
        if entry.endswith(".parquet"):
            out.append(entry[: -len(".parquet")])
        elif st.isDirectory():
            out.append(entry)
    return sorted(out)


def parquet_tenant(spark: SparkSession, name: str, zone: int, path: str,
                   tables: Iterable[str] | None = None, specs: Mapping | None = None) -> Tenant:
    """S1 a tenant stored as one parquet dataset per table under ``path``."""
    names = list(tables) if tables is not None else list_parquet_tables(spark, path)
    frames = {}
    for t in names:
        p = f"{path.rstrip('/')}/{t}.parquet"
        frames[t] = spark.read.parquet(p if path_exists(spark, p) else f"{path.rstrip('/')}/{t}")
    return Tenant(name, zone, frames, specs or {})


def list_tables(spark: SparkSession, database: str, base_only: bool = True) -> list[str]:
    """S3/S5 tables of a catalog database; views are left out when ``base_only``."""
    out = []
    for t in spark.catalog.listTables(database):
        if base_only and (t.tableType or "").upper() == "VIEW":
            continue
        if t.isTemporary:
            continue
        out.append(t.name)
    return sorted(out)


def catalog_tenant(spark: SparkSession, database: str, zone: int, tables: Iterable[str] | None = None,
                   specs: Mapping | None = None) -> Tenant:
    """S1 a tenant living in a catalog database (``spark.table("db.t")``)."""
    names = list(tables) if tables is not None else list_tables(spark, database)
    return Tenant(database, zone, {t: spark.table(f"{database}.{t}") for t in names}, specs or {})


def jdbc_tenant(spark: SparkSession, name: str, zone: int, url: str, tables: Mapping[str, Mapping] | Iterable[str],
                properties: Mapping[str, str] | None = None, specs: Mapping | None = None) -> Tenant:
    """S2 a tenant read over JDBC (one schema of a MySQL-compatible server).

    ``tables`` may map a table to partitioning options
    (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``)
    so large tables are read in parallel slices instead of one connection.
    """
    props = dict(properties or {})
    opts = tables if isinstance(tables, Mapping) else {t: {} for t in tables}
    frames = {}
    for t, o in opts.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", t)
        for k, v in {**props, **dict(o)}.items():
            reader = reader.option(k, str(v))
        frames[t] = reader.load()
    return Tenant(name, zone, frames, specs or {})


def jdbc_table_names(spark: SparkSession, url: str, schema: str, properties: Mapping[str, str] | None = None,
                     base_only: bool = True) -> list[str]:
    """S3/S5 over JDBC: ``information_schema.tables`` (views left out)."""
    q = f"(SELECT table_name, table_type FROM information_schema.tables WHERE table_schema = '{schema}') t"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", q)
    for k, v in (properties or {}).items():
        reader = reader.option(k, str(v))
    rows = reader.load().collect()  # one row per table: catalog metadata only
    return sorted(r[0] for r in rows if not base_only or str(r[1]).upper() == "BASE TABLE")
