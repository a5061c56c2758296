"""All registered queries of the sequence operators, with their oracle SQL."""

from __future__ import annotations

from seqframe.plans import q_align, q_first, q_functions, q_more, q_select, q_stats, registry  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.SQL)
