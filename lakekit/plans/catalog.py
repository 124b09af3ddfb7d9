"""All registered queries; importing the plan modules fills the registry."""

from lakekit.plans import registry
from lakekit.plans import sql_queries, io_queries, warehouse_queries, object_queries, scalar_queries, cluster_queries, stream_queries, scale_queries  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLES)
