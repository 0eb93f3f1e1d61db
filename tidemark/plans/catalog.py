"""All queries of the core package."""

from tidemark.plans import entities, records, story, texts

PARTS = (records, story, entities, texts)


def queries() -> dict:
    return {name: f for part in PARTS for name, f in part.queries().items()}


def oracle_sql() -> dict:
    return {name: sql for part in PARTS for name, sql in part.oracle_sql().items()}
