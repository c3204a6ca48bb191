"""All registered queries."""

from lakemart.parity import models, relational, row_level, storage, streams  # noqa: F401
from lakemart.parity.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
