"""End-to-end flows and the registered queries."""

from claimlens.plans import claim_queries, monitor_queries  # noqa: F401
from claimlens.plans.registry import COVERS, ORACLES, QUERIES  # noqa: F401
