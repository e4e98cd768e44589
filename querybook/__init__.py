"""Registered queries: every operator bound to the test tables, with the SQL that states its result."""

from querybook import base, cleaning, encoding, history, learning, lifecycle, monitoring, reports, storage  # noqa: F401

QUERIES = base.QUERIES
ORACLES = base.ORACLES
