"""Registered queries over the test tables, each with its SQL counterpart."""

from . import cleaning, joins, loads, models, plans, quality, reshaping, sources, summaries  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
