"""Every operator as a query over the driver tables, each with its plain SQL."""

from compdict.queries.registry import ORACLES, QUERIES
from compdict.queries import clean, components, convert, entity, quality, sources  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
