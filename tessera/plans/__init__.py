"""The query catalog: every registered query and its SQL oracle."""

from tessera.plans import graphs, ml, raster, relational, sources, stream, text, web  # noqa: F401  (registers queries)
from tessera.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
