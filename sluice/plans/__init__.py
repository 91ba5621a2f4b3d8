"""Fixed rule tables, the query set over the shared tables, and its check SQL."""

from __future__ import annotations


def all_queries():
    """Every registered query by name."""
    from sluice.plans import (  # noqa: F401
        cloud_queries,
        decision_queries,
        evidence_queries,
        movement_queries,
        quality_queries,
        retrieval_queries,
        sink_queries,
        source_queries,
        text_queries,
        violation_queries,
    )
    from sluice.plans.registry import QUERIES

    return dict(QUERIES)
