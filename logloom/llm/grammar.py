"""The role grammar of a conversation, and its cheapest repairs over a graph-structured stack.

    S -> (nothing) | Q | s Q        Q -> u a | Q u a

`u`, `a` and `s` are the initials of user, assistant and system. The stack of an LR parser for it
is kept as nodes that point to what lies below them. Every action on a turn (keep, rerole, delete,
or insert a turn before it) makes new tops; equal tops merge, and the least (cost, audit) stays.
What lies below a merged top does not matter here: from equal tops the same symbols may follow.

Audits are compared without spelling them out. Before a turn, every top has consumed as many turns
and no insertion is pending, so no audit is a proper beginning of another one: the order of audits
is the order of ranks given at the last turn, then that of what was added since.
"""

from __future__ import annotations

from typing import NamedTuple

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

#: LR states by what was read: 0 nothing, 3 `s`, 2 and 5 `Q` above these, 4 and 6 `u` above
#: 0/3 and 2/5, 7 and 8 the `a` that completes a production.
SHIFT = {0: {"s": 3, "u": 4}, 3: {"u": 4}, 2: {"u": 6}, 5: {"u": 6}, 4: {"a": 7}, 6: {"a": 8}}
LENGTH = {7: 2, 8: 3}
GOTO = {0: 2, 3: 5}
ACCEPTED = (0, 2, 5)


class Node(NamedTuple):
    state: int
    below: Node | None


START = Node(0, None)
_SYSTEM = Node(3, START)
#: A stack for each top that a segment of turns may begin with.
ENTRIES = {n.state: n for n in (START, _SYSTEM, Node(2, START), Node(4, START), Node(5, _SYSTEM),
                                Node(6, Node(2, START)))}


def shift(node: Node, symbol: str) -> Node | None:
    """The stack after `symbol` and all reductions that follow; None if it cannot come next."""
    state = SHIFT[node.state].get(symbol)
    if state is None:
        return None
    node = Node(state, node)
    while node.state in LENGTH:
        for _ in range(LENGTH[node.state]):
            node = node.below
        node = Node(GOTO[node.state], node)
    return node


class Top(NamedTuple):
    """A stack top: its cost, the rank of its audit up to the last turn, and what was added since."""

    cost: int
    rank: int
    added: str
    before: tuple | None
    node: Node


def merge(tops: dict[int, Top], top: Top) -> bool:
    known = tops.get(top.node.state)
    if known is not None and known[:3] <= top[:3]:
        return False
    tops[top.node.state] = top
    return True


def settle(tops: dict[int, Top]) -> dict[int, Top]:
    """Rank the audits and start adding anew."""
    order = {k: n for n, k in enumerate(sorted({(t.rank, t.added) for t in tops.values()}))}
    return {s: Top(t.cost, order[t.rank, t.added], "", (t.before, t.added), t.node)
            for s, t in tops.items()}


def with_inserts(tops: dict[int, Top]) -> dict[int, Top]:
    """All tops that inserted turns lead to, the given ones included."""
    found, new = dict(tops), list(tops.values())
    while new:
        top = new.pop()
        for symbol in ROLES:
            node = shift(top.node, symbol)
            if node is not None:
                more = Top(top.cost + INSERT, top.rank, top.added + "I", top.before, node)
                if merge(found, more):
                    new.append(more)
    return found


def read(tops: dict[int, Top], initial: str, must_go: bool, truncated: bool) -> dict[int, Top]:
    """The tops after one turn."""
    found: dict[int, Top] = {}
    for top in tops.values():
        # an insertion before a deleted turn costs the same after it and then sorts first
        merge(found, top._replace(cost=top.cost + DELETE, added="D"))
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for top in with_inserts(tops).values():
            kept = shift(top.node, initial)
            if kept is not None:
                merge(found, Top(top.cost + KEEP + extra, top.rank, top.added + "K", top.before, kept))
            for symbol in ROLES:
                node = shift(top.node, symbol)
                if node is not None:
                    merge(found, Top(top.cost + REROLE + extra, top.rank, top.added + "R", top.before, node))
    return settle(found)


def spelled(before: tuple | None) -> str:
    parts = []
    while before is not None:
        before, added = before
        parts.append(added)
    return "".join(reversed(parts))


def transfers(entry: int, turns: list[tuple[str, bool, bool]]) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of the cheapest edits of a segment for every top it can end with."""
    tops = {entry: Top(0, 0, "", None, ENTRIES[entry])}
    for turn in turns:
        tops = read(tops, *turn)
    return [(entry, s, t.cost, spelled(t.before)) for s, t in tops.items()]


def joined(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a whole conversation, and for each segment the top it begins with and its audit.

    The insertions that end the conversation belong to the last segment.
    """
    tops, ways = {0: Top(0, 0, "", None, START)}, {0: None}
    for segment in segments:
        found, came = {}, {}
        for entry, to, cost, audit in segment:
            top = tops.get(entry)
            if top is not None and merge(
                    found, Top(top.cost + cost, top.rank, audit, None, ENTRIES[to])):
                came[to] = (ways[entry], entry, audit)
        order = {k: n for n, k in enumerate(sorted({t[1:3] for t in found.values()}))}
        tops = {s: Top(t.cost, order[t[1:3]], "", None, t.node) for s, t in found.items()}
        ways = came
    # which top an insertion started from: mark it in place of the audit so far
    last = with_inserts({s: t._replace(before=(s,)) for s, t in tops.items()})
    best = min((last[s] for s in ACCEPTED if s in last), key=lambda t: t[:3])
    parts, way = [], ways[best.before[0]]
    while way is not None:
        way, entry, audit = way
        parts.append((entry, audit))
    parts.reverse()
    if parts:
        parts[-1] = (parts[-1][0], parts[-1][1] + best.added)
    return best.cost, parts


def apply(entry: int, audit: str, turns: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(role, text, edit) of the turns that remain of a segment, inserted ones included."""
    node, out, place = ENTRIES[entry], [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else turns[place]
        place += edit != "I"
        if edit == "D":
            continue
        if edit != "K":  # in every state at most one of the two may come next
            role = next(r for s, r in ROLES.items() if s in SHIFT[node.state])
        node = shift(node, role[:1])
        out.append((role, text, edit))
    return out
