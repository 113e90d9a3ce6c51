"""The registered queries with the DuckDB text each is checked against."""

from __future__ import annotations

from certweave.plans.catalog import audits, damaged, global_pass, graphs, names, repairs, scalars, sources, tables

MODULES = [scalars, repairs, global_pass, tables, graphs, audits, names, sources, damaged]


def all_queries() -> dict:
    out = {}
    for m in MODULES:
        for key, fn in m.QUERIES.items():
            if key in out:
                raise ValueError(f"query {key} is registered twice")
            out[key] = fn
    return out


def all_oracles() -> dict[str, str]:
    out = {}
    for m in MODULES:
        out.update(m.ORACLES)
    return out
