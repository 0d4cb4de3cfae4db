"""Named queries. Importing this package registers every query module."""

from molarflow.plans.registry import REGISTRY, QuerySpec, Tables, register  # noqa: F401
from molarflow.plans import q_attribution, q_audit, q_kpi, q_funnel, q_leads, q_pull, q_stream, q_misc, q_dashboard, q_index  # noqa: F401

QUERY_MODULES = ("q_attribution", "q_audit", "q_kpi", "q_funnel", "q_leads", "q_pull", "q_stream", "q_misc", "q_dashboard", "q_index")
