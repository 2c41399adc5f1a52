"""All registered queries of the security analytics operators."""

from __future__ import annotations

from sparkwarden.queries import ORACLES, QUERIES
from sparkwarden.queries import detections, learning, relational, sequences, streams, text, verdicts  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
