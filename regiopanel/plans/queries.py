"""All registered queries."""

from regiopanel.plans import feed_queries, panel_queries, run_queries  # noqa: F401
from regiopanel.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
