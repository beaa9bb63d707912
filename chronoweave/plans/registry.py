"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoweave.plans import assembly_queries, asof_queries, imaging_queries, state_queries, stream_queries

_MODULES = [asof_queries, stream_queries, imaging_queries, state_queries, assembly_queries]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query for module in _MODULES for name, query in module.Q.items()}
ORACLE_SQL: dict[str, str] = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
