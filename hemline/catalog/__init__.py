"""Every operator and job as a query over the driver's tables, with its SQL twin.

The tables are flat. Where an operator takes nested documents, text records or files,
Spark derives them row by row from the tables (no row is left out) and the operator
takes them apart again; the SQL states the flat answer.
"""

from hemline.catalog.registry import ORACLES, QUERIES
from hemline.catalog import files, jobs, marts, nested, projections, quality, rankings  # noqa: E402,F401

__all__ = ["QUERIES", "ORACLES"]
