"""Named queries over the test tables, each with its SQL twin where one exists."""

from importlib import import_module

from .registry import REGISTRY

for _module in (
    "gold_queries",
    "market_queries",
    "merge_queries",
    "run_queries",
    "landing_queries",
    "text_queries",
    "rule_queries",
    "resolve_queries",
    "quality_queries",
):
    import_module(f"{__name__}.{_module}")

__all__ = ["REGISTRY"]
