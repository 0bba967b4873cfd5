"""The query registry: every implemented operator as (spark, sf_dir) -> DataFrame,
and the DuckDB SQL oracle for the keys SQL can express."""

from __future__ import annotations

from reviewlab.plans import (drift_registry_oracle, drift_registry_queries, io_oracle, io_queries, model_oracle,
                             model_queries, profile_oracle, profile_queries)


def queries() -> dict:
    out = {}
    out.update(profile_queries.QUERIES)
    out.update(model_queries.QUERIES)
    out.update(drift_registry_queries.QUERIES)
    out.update(io_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(profile_oracle.SQL)
    out.update(model_oracle.SQL)
    out.update(drift_registry_oracle.SQL)
    out.update(io_oracle.SQL)
    q = queries()
    return {k: v for k, v in out.items() if k in q}
