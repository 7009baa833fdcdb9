"""Registered queries over the driver tables and their SQL counterparts."""

from .catalog import ORACLES, QUERIES
from . import scans, rows, joins, aggregates, windows, places, ends  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
