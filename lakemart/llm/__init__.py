"""Operators for preparing training data, and their registered queries."""

from lakemart.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
