"""shardfold: consolidate many same-shaped databases (tenants) into one, on Spark.

Layout:

* ``model``       Tenant, TableSpec
* ``sources``     tenant sources (parquet, catalog, JDBC) and sinks (versioned write, report)
* ``functions``   column-expression builders (shift, affix, guid zone, first-row order keys)
* ``operators``   rows (P*), merge (M*), keys (K*), names (N*), identity (I1-I13), retention (I14-I18)
* ``plans``       rule-driven remap (K10), merge jobs (R1-R5), the account/player/guild
                  reconcile preset, the command line (``python -m shardfold``), the query catalogue
"""

from .model import TableSpec, Tenant

__all__ = ["Tenant", "TableSpec"]
