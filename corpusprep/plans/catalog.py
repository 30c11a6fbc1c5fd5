"""All registered queries and their SQL oracles, gathered from the query modules."""

from __future__ import annotations

from . import cleaning_queries, reader_queries, stream_udf_queries, training_queries


def queries():
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _modules():
        out.update(m.ORACLES)
    return out


def _modules():
    return [cleaning_queries, training_queries, stream_udf_queries, reader_queries]
