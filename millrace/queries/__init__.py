"""All registered queries."""

from millrace.queries import (  # noqa: F401
    q_changes, q_columns, q_customers, q_edges, q_geo, q_inventory, q_model_facts, q_models, q_relational, q_sources,
    q_streams,
)
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
