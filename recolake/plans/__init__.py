"""Job plans and the registry of checked queries."""


def load_all():
    """Import every query module so that it registers its queries."""
    from recolake.plans import (als_queries, content_queries, kv_queries,  # noqa: F401
                                model_queries, stats_queries)
    from recolake.plans.registry import REGISTRY
    return REGISTRY
