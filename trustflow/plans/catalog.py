"""All registered queries."""

from trustflow.plans import (  # noqa: F401
    q_delivery,
    q_events,
    q_evidence,
    q_facts,
    q_health,
    q_rules,
    q_snapshot,
    q_stream,
)
from trustflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
