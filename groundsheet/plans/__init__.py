"""Runnable queries, one or more per operator, with the SQL that checks them."""

from groundsheet.plans import (  # noqa: F401
    geometries,
    observation,
    processing,
    scans,
    shapes,
    spatial,
    states,
    structured,
    symbology,
    texts,
)
from groundsheet.plans.catalog import ORACLE, QUERIES  # noqa: F401
