"""The vectorised per-micro-batch steps of the stream processors, chunked at random, against the
one-record-at-a-time simulation (no Spark needed)."""

import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from sim import counts, simulate_pairing, simulate_rules
from tidal.streaming.pairing import KIND, arrival_sorted, pair_batch
from tidal.streaming.rules import gate_actions

BASE = dt.datetime(2024, 1, 1)


def chunks(items, cuts):
    edges = sorted({c % (len(items) + 1) for c in cuts} | {0, len(items)})
    return [items[a:b] for a, b in zip(edges, edges[1:])]


pair_ev = st.tuples(st.sampled_from(["u", "a"]), st.sampled_from(["p", "q", None]), st.integers(0, 5))


@settings(max_examples=300, deadline=None)
@given(st.lists(pair_ev, max_size=30), st.lists(st.integers(0, 40), max_size=4))
def test_pair_batches_match_simulation(evs, cuts):
    # arrival order across micro-batches is processing order: sort once, then cut
    events = sorted([("k", k, v, BASE + dt.timedelta(seconds=t), i) for i, (k, v, t) in enumerate(evs)],
                    key=lambda e: (e[3], 0 if e[1] == "u" else 1, e[4]))
    user = waiting = None
    got = []
    for part in chunks(events, cuts):
        if not part:
            continue
        frame = pd.DataFrame({
            KIND: [0 if e[1] == "u" else 1 for e in part],
            "ts": [e[3] for e in part], "seq": [e[4] for e in part],
            "name": [e[2] if e[1] == "u" else None for e in part],
            "action": [e[2] if e[1] == "a" else None for e in part]})
        out, user, waiting = pair_batch(arrival_sorted([frame]), user, waiting)
        got += [("k", r.name, r.action, r.seq) for r in out.itertuples()]
    assert counts(got) == counts(simulate_pairing(events))


rule_ev = st.one_of(
    st.tuples(st.just("r"), st.lists(st.sampled_from(["p", "q", None]), max_size=2), st.integers(0, 5)),
    st.tuples(st.just("a"), st.sampled_from(["p", "q", None]), st.integers(0, 5)))


@settings(max_examples=300, deadline=None)
@given(st.lists(rule_ev, max_size=30), st.lists(st.integers(0, 40), max_size=4))
def test_gate_batches_match_simulation(evs, cuts):
    events = sorted([(k, f"{k}{i}", p, BASE + dt.timedelta(seconds=t), i)
                     for i, (k, p, t) in enumerate(evs)],
                    key=lambda e: (e[3], 0 if e[0] == "r" else 1, e[4]))
    # rules and actions fall into batches apart: all rules of a batch and of those before are known to its actions
    held, got = [], []
    for part in chunks(events, cuts):
        held += [((e[3] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1), e[4], e[2]) for e in part if e[0] == "r"]
        acts = [e for e in part if e[0] == "a"][::-1]
        if not acts:
            continue
        frame = pd.DataFrame({
            "ts": [e[3] for e in acts], "seq": [e[4] for e in acts], "actionId": [e[1] for e in acts],
            "userId": ["u"] * len(acts), "action": [e[2] for e in acts]})
        got += [(r.actionId, r.action, r.seq) for r in gate_actions(frame, sorted(held, key=lambda r: r[:2])).itertuples()]
    assert counts(got) == counts(simulate_rules(events))
