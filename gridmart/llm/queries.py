"""Registry of the training-data queries: name -> callable, name -> DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from gridmart.llm import q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13

_MODULES = (q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13)


def registry() -> dict:
    return {**{m.NAME: m.query for m in _MODULES}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    out = {m.NAME: m.SQL for m in _MODULES if m.SQL is not None}
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
