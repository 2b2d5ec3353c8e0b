"""fundlens: Spark-native analytics and scoring for crowdfunding campaign tables.

Every operator is a DataFrame -> DataFrame function; the registry in
``fundlens.plans.registry`` maps query keys to those operators and to DuckDB
oracle SQL for the correctness gate.

    from fundlens import get_session, campaigns, queries
    spark = get_session()
    queries()["success_by_category"](spark, "/path/to/tables").show()

Modules: ``sources`` (campaigns table, CSV/Parquet/JSON), ``functions``
(row-level columns), ``operators`` (clean, enrich, profile, dashboard,
sampling, features, models, evaluation, learning), ``streaming`` (file-stream
ingestion), ``jobs`` (batch CLI).
"""

__version__ = "0.1.0"

__all__ = ["get_session", "campaigns", "queries", "oracle_sql"]


def get_session(*args, **kwargs):
    from .session import get_session as _get

    return _get(*args, **kwargs)


def campaigns(spark, sf_dir, columns=None, live=None):
    from .sources.campaigns import campaigns as _campaigns

    return _campaigns(spark, sf_dir, columns, live)


def queries():
    from .plans.registry import queries as _q

    return _q()


def oracle_sql():
    from .plans.registry import oracle_sql as _o

    return _o()
