"""Brute-force, row-at-a-time model of dedup + validation semantics, used
only by tests to check the Spark plans (closed-form windows, chunked scans,
segmented fold, streamed batches)."""

from __future__ import annotations

from ordwise.functions.lifecycle import STATE_RANKS as RANKS


def route_all(events, mode="drop", dedup_ttl_us=600_000_000, state_ttl_us=None):
    """events: iterable of dicts with order_id, event_id, event_type,
    arrival_us, arrival_seq. Returns {arrival_seq: (route, is_dup)}."""
    out = {}
    seen = {}   # (order, id) -> last sighting
    state = {}  # order -> (rank, write_us)
    for e in sorted(events, key=lambda e: (e["arrival_us"], e["arrival_seq"])):
        o, i, t = e["order_id"], e["event_id"], e["arrival_us"]
        last = seen.get((o, i))
        dup = last is not None and (dedup_ttl_us is None or t - last < dedup_ttl_us)
        seen[(o, i)] = t
        rk = RANKS.get(e["event_type"])
        if rk is None:
            out[e["arrival_seq"]] = ("quarantine", dup)
            continue
        if mode == "drop" and dup:
            out[e["arrival_seq"]] = ("duplicate", dup)
            continue
        st = state.get(o)
        alive = st is not None and (state_ttl_us is None or t - st[1] < state_ttl_us)
        if not alive or rk >= st[0]:
            state[o] = (rk, t)
            out[e["arrival_seq"]] = ("valid", dup)
        else:
            out[e["arrival_seq"]] = ("invalid", dup)
    return out
