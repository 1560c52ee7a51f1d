"""Registry of queries over the given tables, with their SQL checks."""

from __future__ import annotations

from feedmill.queries.tables import Query


def all_queries() -> dict[str, Query]:
    from feedmill.queries import jobs, mappings, monitoring, quality, relational

    out: dict[str, Query] = {}
    for module in (jobs, monitoring, relational, quality, mappings):
        for name, query in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query registered twice: {name}")
            out[name] = query
    return out
