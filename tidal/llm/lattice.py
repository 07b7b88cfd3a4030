"""The lattice of edits of a conversation, solved layer by layer with the auction algorithm for shortest paths.

Nodes are (rows read, state); the state is the role sequence so far: nothing, system first, after a user turn,
after an assistant turn. Arcs are the edits: keep (K), rerole (R) and delete (D) read a row, insert (I) stays. A state
has one legal next role, so a label leads to one node and the labels of a path fix the repaired conversation.

*Auction.* Every node has a price, a lower bound of its distance to the end that satisfies
``price(i) <= cost(i, j) + price(j)``. From an origin, the path is extended over an arc that holds with equality;
where none does, the end's price rises to ``min(cost + price)`` and the path is contracted. On reaching a node whose
price is settled, the prices on the path are exact. Origins are taken layer by layer from the end, starting a layer's
prices at the least of the layer read next, so a path is as short as a layer. All prices being exact then, the tight
arcs (those holding with equality) are those of the shortest paths, and following the least label at each node gives
the ASCII-least audit.

Prices of a layer relative to their least one take few values (``VECTORS``), so a layer's auction is run once per
(row code, relative prices of the next layer) and kept; a block of rows is a map between such vectors.
"""

from __future__ import annotations

import functools

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)            # the state after a legal user or assistant turn
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs
SOUND, CUT, BAD = range(3)                      # a row's fault: none, truncated, one that asks for deletion
CODES = 12                                      # 3 * initial (s, u, a, other) + fault


def code(initial: str, fault: int) -> int:
    return 3 * {"s": 0, "u": 1, "a": 2}.get(initial, 3) + fault


def _arcs(row: int | None) -> list[list[tuple[str, int, int]]]:
    """Arcs (label, cost, target) of the four states of a layer; targets 4-7 are those of the next layer.

    ``row`` is the code of the row read, None for the last layer, where the end (node 4) takes the
    states that a conversation may end in."""
    out = [[("I", INSERT, NEXT[q])] for q in range(4)]
    if row is None:
        for q in (START, ASSISTANT):
            out[q].append(("", 0, 4))
        return out
    initial, fault = divmod(row, 3)
    for q in range(4):
        out[q].append(("D", DELETE, 4 + q))
        if fault != BAD:
            extra = TRUNCATED if fault == CUT else 0
            out[q].append(("R", REROLE + extra, 4 + NEXT[q]))
            if initial == 0 and q == START:
                out[q].append(("K", extra, 4 + SYSTEM))
            elif (initial == 1 and NEXT[q] == USER) or (initial == 2 and NEXT[q] == ASSISTANT):
                out[q].append(("K", extra, 4 + NEXT[q]))
    return out


def auction(arcs: list[list[tuple[str, int, int]]], price: list[int], settled: set[int], origin: int) -> None:
    """Raise prices until the path from ``origin`` meets a settled node; settles the path's nodes.

    ``price`` holds lower bounds with price(i) <= cost + price(j) on every arc. Costs are integers and cycles
    cost more than nothing."""
    path = [origin]
    while path[-1] not in settled:
        i = path[-1]
        best, to = min((cost + price[j], j) for _, cost, j in arcs[i])
        if price[i] < best:
            price[i] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)
    settled.update(path)


@functools.cache
def layer(row: int | None, after: tuple[int, ...] = (0,)) -> tuple[tuple[int, ...], int, tuple[tuple[str, int], ...]]:
    """(relative prices, their least one, per state the labels up to the next row and the state there) of a layer.

    ``after``: the relative prices of the next layer (of the end, for the last)."""
    arcs = _arcs(row)
    price = [min(after)] * 4 + list(after)
    settled = set(range(4, len(price)))
    for q in range(4):
        if q not in settled:
            auction(arcs, price, settled, q)
    moves = []
    for q in range(4):
        labels, at = "", q
        while at < 4:
            label, _, to = min((a for a in arcs[at] if price[at] == a[1] + price[a[2]]), key=lambda a: a[0])
            labels, at = labels + label, to
        moves.append((labels, at - 4))
    least = min(price[:4])
    return tuple(p - least for p in price[:4]), least, tuple(moves)


LAST = layer(None)


def _vectors() -> list[tuple[int, ...]]:
    found = [LAST[0]]
    for v in found:
        for c in range(CODES):
            if (w := layer(c, v)[0]) not in found:
                found.append(w)
    return found


VECTORS = _vectors()
_NUMBER = {v: i for i, v in enumerate(VECTORS)}
_BEFORE = np.array([[_NUMBER[layer(c, v)[0]] for v in VECTORS] for c in range(CODES)])
_RISE = np.array([[layer(c, v)[1] for v in VECTORS] for c in range(CODES)])


def block_map(codes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind a block of rows: the number of the vector before it, and how much the least price rises."""
    at, rise = np.arange(len(VECTORS)), np.zeros(len(VECTORS), np.int64)
    for c in reversed(codes):
        rise += _RISE[c][at]
        at = _BEFORE[c][at]
    return at, rise


def ways(codes: bytes, behind: int) -> list[tuple[tuple[str, int], ...]]:
    """Per row the moves (labels, next state) of every state, given the number of the vector behind the block."""
    out, v = [], VECTORS[behind]
    for c in reversed(codes):
        v, _, moves = layer(c, v)
        out.append(moves)
    return out[::-1]


def exits(codes: bytes, behind: int) -> list[int]:
    """The state behind a block for every state before it."""
    at = [0, 1, 2, 3]
    for moves in ways(codes, behind):
        at = [moves[q][1] for q in at]
    return at


def cost(codes: bytes) -> int:
    """The cost of the cheapest edits of a whole conversation."""
    at, rise = block_map(codes)
    return int(VECTORS[at[0]][START] + rise[0])


def trace(codes: bytes, behind: int = 0, state: int = START, last: bool = True) -> list[str]:
    """The labels of every row of a block (inserts before it included), and at the ``last`` one those after it."""
    out = []
    for moves in ways(codes, behind):
        labels, state = moves[state]
        out.append(labels)
    if last:
        out.append(LAST[2][state][0])
    return out


def apply(labels: list[str], rows: list[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """The repaired turns (role, text): ``labels`` of ``trace`` applied to the rows it read."""
    out = []
    for i, steps in enumerate(labels):
        for step in steps:
            if step == "D":
                continue
            role, text = rows[i] if step in "KR" else ("", "")
            if step == "K" and role[:1] == "s":
                state = SYSTEM
            else:
                state = NEXT[state]
                role = role if step == "K" else ROLE[state]
            out.append((role, text))
    return out
