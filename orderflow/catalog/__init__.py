"""All operators as named queries over the given tables, with the SQL they are checked against."""

from orderflow.catalog import day, files, items, matching, people, runs, scalars, shapes  # noqa: F401
from orderflow.catalog.registry import CHECKS, QUERIES  # noqa: F401
