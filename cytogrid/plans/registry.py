"""Registry of the queries over the test tables and of the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: The domain tables as SQL over the test tables; plans/views.py has the same as DataFrames.
VIEWS = """
counts AS (
  SELECT c_mktsegment AS sample, 'cell_' || CAST(o_orderkey AS VARCHAR) AS cell_id, replace(p_name, ' ', '-') AS gene, CAST(sum(l_quantity) AS BIGINT) AS count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3),
cells AS (
  SELECT c_mktsegment AS sample, 'cell_' || CAST(o_orderkey AS VARCHAR) AS cell_id, o_totalprice / 1000 AS x, c_acctbal / 100 AS y,
    r_name AS region_annotation, o_orderpriority AS cell_type, n_name AS niche, o_orderstatus AS condition
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
genes AS (SELECT DISTINCT replace(p_name, ' ', '-') AS gene FROM part),
spots AS (
  SELECT 's' || CAST(vec_id % 3 AS VARCHAR) AS sample, 'v' || CAST(vec_id AS VARCHAR) AS cell_id, vec_id,
    round(CAST(embedding[1] AS DOUBLE) * 1000, 3) AS x, round(CAST(embedding[2] AS DOUBLE) * 1000, 3) AS y, 'c' || CAST(label AS VARCHAR) AS label
  FROM embeddings)
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; ``sql`` may use the domain tables of VIEWS and start with further ``WITH`` parts."""

    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            body = sql.strip()
            _SQL[f.__name__] = f"WITH {VIEWS.strip()}" + (", " + body[5:] if body.startswith("WITH ") else " " + body)
        return f

    return put


def _load() -> None:
    from cytogrid.plans import queries_branches, queries_core, queries_numeric, queries_spatial, queries_stats, queries_text  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
