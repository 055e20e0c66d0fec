"""Order lifecycle domain: states, ranks and the transition graph.

Ranks and edges are tiny fixed dimensions; they are applied as literal maps
(`create_map`), so they never cause a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference for identical results) ---------
# Lifecycle states and their rank, in rank order.
STATE_RANKS = {
    "ORDER_PENDING": 1,
    "ORDER_PAID": 2,
    "ORDER_SHIPPED": 3,
    "ORDER_DELIVERED": 4,
    "ORDER_CANCELLED": 5,
    "ORDER_PAID_CANCELLED": 6,
    "ORDER_RETURNED": 7,
    "ORDER_REFUNDED": 8,
}
# Allowed transitions (from -> to) of the lifecycle graph.
EDGES = [
    ("ORDER_PENDING", "ORDER_PAID"),
    ("ORDER_PENDING", "ORDER_CANCELLED"),
    ("ORDER_PAID", "ORDER_SHIPPED"),
    ("ORDER_PAID", "ORDER_PAID_CANCELLED"),
    ("ORDER_SHIPPED", "ORDER_DELIVERED"),
    ("ORDER_SHIPPED", "ORDER_PAID_CANCELLED"),
    ("ORDER_DELIVERED", "ORDER_RETURNED"),
    ("ORDER_RETURNED", "ORDER_REFUNDED"),
    ("ORDER_PAID_CANCELLED", "ORDER_REFUNDED"),
]
# ---------------------------------------------------------------------------

RANK_STATES = {v: k for k, v in STATE_RANKS.items()}


def _literal_map(d: dict) -> Column:
    args = []
    for k, v in d.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def rank_of(event_type: Column | str) -> Column:
    """Rank of a state name; null for unknown names."""
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    return _literal_map(STATE_RANKS)[c].cast("int")


def state_of(rank: Column | str) -> Column:
    """State name of a rank; null for null or unknown ranks."""
    c = F.col(rank) if isinstance(rank, str) else rank
    return _literal_map(RANK_STATES)[c]


def is_edge(from_state: Column, to_state: Column) -> Column:
    """True when (from, to) is an edge of the graph; evaluated in-line."""
    cond = F.lit(False)
    for a, b in EDGES:
        cond = cond | ((from_state == F.lit(a)) & (to_state == F.lit(b)))
    return cond


def rank_case_sql(col: str) -> str:
    """SQL CASE mapping a state name to its rank (for the SQL oracles)."""
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in STATE_RANKS.items())
    return f"(CASE {col} {whens} END)"


def state_case_sql(col: str) -> str:
    whens = " ".join(f"WHEN {v} THEN '{k}'" for k, v in STATE_RANKS.items())
    return f"(CASE {col} {whens} END)"


def edges_values_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}')" for a, b in EDGES)
    return f"(VALUES {rows})"
