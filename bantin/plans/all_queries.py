"""Loads every module of queries."""

from bantin.plans import dates, extraction, keywords, lookups, merges, messages, search, streams  # noqa: F401
from bantin.plans.registry import QUERIES, SQL  # noqa: F401
