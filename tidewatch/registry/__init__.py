"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from . import aggregates, entities, files, flows, incremental, joins, scalars, windows  # noqa: F401, I001
from . import dirty  # noqa: F401
from .book import BOOK

__all__ = ["BOOK"]
