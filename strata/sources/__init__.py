"""Table storage and source reads."""

from strata.sources.tables import TableStore

__all__ = ["TableStore"]
