"""Queries of the library bound to the driver's tables, each with its SQL counterpart."""

from bindings import cleaning, features, loading, model, quality, validation

_MODULES = (features, cleaning, validation, loading, model, quality)

QUERIES = {key: query for m in _MODULES for key, query in m.QUERIES.items()}
ORACLE = {key: sql.strip() for m in _MODULES for key, sql in m.ORACLE.items()}
