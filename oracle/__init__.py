"""DuckDB SQL oracles for the registered queries.

Each query is written independently of the Spark code, as plain SQL with
window functions and joins over the pre-registered parquet views, often by
brute force (e.g. a full theta join where Spark uses a bounded plan).
Shared CTE blocks live in ``ctes``.
"""

from oracle.queries import ORACLE_SQL  # noqa: F401
