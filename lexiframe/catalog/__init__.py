"""Queries over the given tables, each with its SQL twin where SQL can say it."""

from . import files, labels, models, relational, rows, text

MODULES = (rows, text, labels, files, models, relational)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
