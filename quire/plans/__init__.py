"""Named end-to-end queries over the driver tables (see ``registry``)."""

from quire.plans import annotation, corpus, graph, history, pages, sources, store, stream  # noqa: F401  (registers queries)
from quire.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
