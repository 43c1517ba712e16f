"""Registered queries, one module per operator family, each next to its SQL twin."""

from docketry.catalog import calls, cdc, certificates, documents, fields, projections, scans, scoring, streams, topics, training  # noqa: F401
from docketry.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
