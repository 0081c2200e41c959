"""Named queries over the driver's tables, each paired with DuckDB oracle SQL."""

from . import fitted, hierarchies, lexicons, samples  # noqa: F401
from .catalog import ORACLE, QUERIES  # noqa: F401
