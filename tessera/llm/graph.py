"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from tessera.operators.graph import components

__all__ = ["components"]
