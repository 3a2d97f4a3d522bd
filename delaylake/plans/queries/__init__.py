"""The registered queries."""

from . import cleaning, features, jobs, joins, learning, serving, sinks, sources, streams  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
