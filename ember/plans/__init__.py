"""Named queries over the driver's tables (see ``registry``)."""

from . import aggregates, graph, logs, ml, orders, streaming, text, topk, weather  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
