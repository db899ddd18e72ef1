"""Imports every module that registers queries."""

from . import control_queries, feed_queries, holding_queries, lending_queries, posting_queries, proof_queries, quality_queries, stream_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
