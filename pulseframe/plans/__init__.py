"""The registered queries of the library and their SQL."""

from . import aggregates, ingestion, projections, quality, streams  # noqa: F401
from .registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
