"""Registered queries over the sample tables, each with the SQL that gives the same rows."""

from . import datasets, dedup, jobs, records, schemas, text

_MODULES = (text, records, dedup, schemas, datasets, jobs)


def all_queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
