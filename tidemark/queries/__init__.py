"""All registered queries; importing a module registers what it holds."""

from tidemark.queries import catalog, holdings, loads, prices, ranges, streams, watch  # noqa: F401
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
