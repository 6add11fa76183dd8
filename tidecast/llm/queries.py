"""All corpus queries and their SQL, filled by importing the operators."""

from __future__ import annotations

from . import (  # noqa: F401
    bpe, decontaminate, divergence, langid, lines, lm, preferences, quality, shards, simhash, spelling, tokens, warc,
)
from .common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
