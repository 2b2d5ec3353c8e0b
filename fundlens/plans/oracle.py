"""DuckDB oracle SQL for the correctness gate.

Each statement starts from the same ``campaigns`` definition as
``fundlens.sources.campaigns`` written as a CTE over the driver tables, so
the oracle checks the whole chain: view, operator, rounding.
"""

from __future__ import annotations

CAMPAIGNS_CTE = """
WITH li AS (
  SELECT l_orderkey AS id,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS pledged,
         CAST(COUNT(*) AS INTEGER) AS backers_count,
         CAST(epoch(MAX(l_shipdate)) AS BIGINT) AS deadline
  FROM lineitem GROUP BY l_orderkey
), campaigns AS (
  SELECT o.o_orderkey AS id, c.c_mktsegment AS category, n.n_name AS country,
         o.o_totalprice AS goal, li.pledged, li.backers_count,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS created_at,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS launched_at,
         li.deadline, (o.o_orderpriority = '1-URGENT') AS staff_pick,
         CAST(CASE WHEN li.pledged >= o.o_totalprice THEN 1 ELSE 0 END AS INTEGER) AS state,
         d.text AS blurb, c.c_name AS name, c.c_name AS creator
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN li ON li.id = o.o_orderkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey
)"""


def with_campaigns(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the campaigns CTE (and optional further CTEs)."""
    ctes = CAMPAIGNS_CTE + (",\n" + extra_ctes.strip() if extra_ctes.strip() else "")
    return ctes + "\n" + body.strip()


# Shared SQL fragments mirroring fundlens.functions.columns.
RATE = "ROUND(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE), 6)"
SUCCESS_RATE = "ROUND(CAST(SUM(CASE WHEN state = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) AS DOUBLE), 6)"
SUCCESS_FLAG = "CASE WHEN state = 1 THEN 'Successful' ELSE 'Failed' END"
FUNDING_PCT = "(pledged / goal)"
GOAL_TIER = ("CASE WHEN goal < 1000 THEN '< $1K' WHEN goal < 5000 THEN '$1K-$5K' "
             "WHEN goal < 10000 THEN '$5K-$10K' WHEN goal < 50000 THEN '$10K-$50K' ELSE '$50K+' END")
OVERFUNDED = "CASE WHEN (pledged / goal) > 1 THEN 'Overfunded' ELSE 'Underfunded' END"
EPOCH_DAY = "CAST(floor({c} / 86400.0) AS BIGINT)"
CREATED_MONTH = "CAST(date_trunc('month', DATE '1970-01-01' + CAST(floor(created_at / 86400.0) AS INTEGER)) AS DATE)"
DURATION_DAYS = "(CAST(floor(deadline / 86400.0) AS BIGINT) - CAST(floor(launched_at / 86400.0) AS BIGINT))"
COMPLETENESS = ("ROUND(1.0 - CAST(SUM(CASE WHEN blurb IS NULL THEN 1 ELSE 0 END) + "
                "SUM(CASE WHEN goal IS NULL THEN 1 ELSE 0 END) + "
                "SUM(CASE WHEN category IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) * 3 AS DOUBLE), 6)")

VALIDATED_CTE = """validated AS (
  SELECT * FROM campaigns
  WHERE goal > 0 AND state IN (0, 1) AND category IS NOT NULL AND country IS NOT NULL
    AND launched_at IS NOT NULL AND deadline IS NOT NULL)"""

FEATURES_CTE = """features AS (
  SELECT id, goal, category, country, launched_at, deadline, CAST(staff_pick AS INTEGER) AS staff_pick,
         state, deadline - launched_at AS duration, ln(1 + goal) AS goal_log
  FROM validated)"""


def double_lit(v: float) -> str:
    if v == float("inf"):
        return "CAST('inf' AS DOUBLE)"
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def bucket_sql(col: str, splits) -> str:
    """Bucketizer semantics in plain SQL: the index of the last split <= x
    (the last bucket also holds its upper bound), NaN to an extra bucket."""
    n = len(splits) - 1
    arms = [f"WHEN {col} IS NULL THEN NULL", f"WHEN isnan({col}) THEN {n}"]
    # splits[n] is the closing bound (+inf here): x equal to it stays in bucket n-1
    for i in range(n - 1, -1, -1):
        arms.append(f"WHEN {col} >= {double_lit(splits[i])} THEN {i}")
    return "CAST(CASE " + " ".join(arms) + " ELSE NULL END AS INTEGER)"


def hash_unit_sql(key: str = "id", seed: int = 42, salt: str = "") -> str:
    prefix = f"{seed}:{salt + ':' if salt else ''}"
    return f"CAST(('0x' || substr(md5('{prefix}' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


def index_sql(col: str, source: str, alphabetical: bool = False) -> str:
    """StringIndexer codes: frequency desc then value asc, or value asc."""
    order = f"{col} ASC" if alphabetical else f"COUNT(*) DESC, {col} ASC"
    return (f"SELECT {col} AS v, CAST(ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS idx "
            f"FROM {source} WHERE {col} IS NOT NULL GROUP BY {col}")
