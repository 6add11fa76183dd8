"""The operators as named queries over the test tables, each with its SQL check."""

from __future__ import annotations

from . import (  # noqa: F401  (importing fills the registry)
    audience,
    gifts,
    orders,
    products,
    records,
    sinks,
    streams,
    users,
)
from .registry import REGISTRY

__all__ = ["REGISTRY"]
