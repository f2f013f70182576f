"""Minimal acyclic transducers: sorted terms as an automaton whose paths add up to the terms' ordinals."""

from __future__ import annotations

import numpy as np

FIELDS = ("root", "final", "first", "bits", "before", "target", "weight")
_TYPES = {"root": np.int32, "final": np.bool_, "first": np.int32, "bits": np.uint64, "before": np.uint8, "target": np.int32, "weight": np.int32}


def build(terms: list[bytes]) -> dict[str, np.ndarray]:
    """The smallest automaton that accepts just `terms`, which are distinct and in byte order.

    States of the term before that the next one does not share are closed from its end: one that equals an earlier state is
    replaced by it. An edge weighs as many terms as its state accepts before those behind the edge, so the weights along a
    term add up to its place in the order. A state has a bit per byte it can read; its edges lie in byte order.
    """
    known: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, state), ...))
    counts: list[int] = []  # terms accepted from a state
    path: list[list] = [[False, []]]  # states along the term before, open

    def close(state: list) -> int:
        content = (state[0], tuple(state[1]))
        if content not in known:
            known[content] = len(states)
            states.append(content)
            counts.append(state[0] + sum(counts[s] for _, s in state[1]))
        return known[content]

    last = b""
    for n, term in enumerate(terms):
        if n and term <= last:
            raise ValueError("terms are not in order")
        shared = 0
        while shared < min(len(last), len(term)) and last[shared] == term[shared]:
            shared += 1
        for i in range(len(last), shared, -1):
            closed = close(path.pop())
            path[-1][1].append((last[i - 1], closed))
        path += [[False, []] for _ in term[shared:]]
        path[-1][0] = True
        last = term
    for i in range(len(last), 0, -1):
        closed = close(path.pop())
        path[-1][1].append((last[i - 1], closed))
    root = close(path[0])

    first = np.zeros(len(states), np.int32)
    bits = np.zeros((len(states), 4), np.uint64)
    before = np.zeros((len(states), 4), np.uint8)
    target, weight = [], []
    for s, (final, edges) in enumerate(states):
        first[s] = len(target)
        ahead = int(final)
        words = [0, 0, 0, 0]
        for byte, to in edges:
            words[byte >> 6] |= 1 << (byte & 63)
            target.append(to)
            weight.append(ahead)
            ahead += counts[to]
        bits[s] = words
        before[s, 1:] = np.cumsum([w.bit_count() for w in words[:3]])
    return {"root": np.array([root], np.int32), "final": np.array([f for f, _ in states], np.bool_), "first": first, "bits": bits, "before": before,
            "target": np.array(target, np.int32), "weight": np.array(weight, np.int32)}


def to_bytes(machine: dict[str, np.ndarray]) -> list[bytes]:
    return [machine[f].tobytes() for f in FIELDS]


def from_bytes(parts: list[bytes]) -> dict[str, np.ndarray]:
    machine = {f: np.frombuffer(p, _TYPES[f]) for f, p in zip(FIELDS, parts)}
    return machine | {f: machine[f].reshape(-1, 4) for f in ("bits", "before")}


def ordinals(machine: dict[str, np.ndarray], data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place in the order of each term data[start:end], -1 for those not accepted; all terms take a step at a time."""
    out = np.full(len(start), -1, np.int64)
    on = np.arange(len(start))
    at, state, total = start.astype(np.int64), np.full(len(start), machine["root"][0], np.int64), np.zeros(len(start), np.int64)
    while len(on):
        ended = at == end[on]
        there = ended & machine["final"][state]
        out[on[there]] = total[there]
        left = ~ended
        on, at, state, total = on[left], at[left], state[left], total[left]
        byte = data[at]
        word, bit = machine["bits"][state, byte >> 6], (byte & 63).astype(np.uint64)
        goes = (word >> bit) & np.uint64(1) == 1
        edge = machine["first"][state] + machine["before"][state, byte >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        on, at, edge, total = on[goes], at[goes] + 1, edge[goes], total[goes]
        total = total + machine["weight"][edge]
        state = machine["target"][edge].astype(np.int64)
    return out


def term_at(machine: dict[str, np.ndarray], ordinal: int) -> bytes:
    """The term at a place in the order."""
    out, state = bytearray(), int(machine["root"][0])
    while True:
        if not ordinal and machine["final"][state]:
            return bytes(out)
        word = [int(w) for w in machine["bits"][state]]
        held = [b for b in range(256) if word[b >> 6] >> (b & 63) & 1]
        lo = int(machine["first"][state])
        k = int(np.searchsorted(machine["weight"][lo:lo + len(held)], ordinal, "right")) - 1
        out.append(held[k])
        ordinal -= int(machine["weight"][lo + k])
        state = int(machine["target"][lo + k])
