"""Helpers for array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Higher-order functions are evaluated without subexpression elimination:
    an expression referenced several times (or inside a lambda) is computed
    each time. Binding it as a lambda variable computes it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
