"""Brute-force simulations of the two state machines, one record at a time (test oracle)."""

from __future__ import annotations

from collections import defaultdict


def simulate_pairing(events):
    """events: iterable of (userId, kind 'u'|'a', value, ts, seq) -> list of output tuples
    (userId, name, action, seq), applying records in (ts, u before a, seq) order per user."""
    order = sorted(events, key=lambda e: (e[3], 0 if e[1] == "u" else 1, e[4]))
    user, waiting = {}, {}
    out = []
    for uid, kind, value, ts, seq in order:
        if uid is None:
            continue
        if kind == "u":
            if uid in waiting:
                out.append((uid, value, waiting.pop(uid), seq))
            else:
                user[uid] = value
        else:
            if uid in user:
                out.append((uid, user[uid], value, seq))
            else:
                waiting[uid] = value
    return out


def simulate_rules(events):
    """events: iterable of ('r', ruleId, allowed, ts, seq) or ('a', actionId, action, ts, seq)
    -> list of passing (actionId, action, seq)."""
    order = sorted(events, key=lambda e: (e[3], 0 if e[0] == "r" else 1, e[4]))
    rule = None
    out = []
    for kind, ident, payload, ts, seq in order:
        if kind == "r":
            rule = payload
        elif rule is not None and payload in rule:
            out.append((ident, payload, seq))
    return out


def counts(rows):
    c = defaultdict(int)
    for r in rows:
        c[tuple(r)] += 1
    return dict(c)
