"""Driver-facing queries by theme."""

from stratiq.queries import freezes, graphs, joins, labels, ledgers, rules, texts, times, versions, windows  # noqa: F401
from stratiq.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
