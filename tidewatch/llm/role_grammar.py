"""Generalised LR parsing of role sequences, with edits.

The parser keeps all stacks that any choice of edits can give. Stacks are nodes that share what lies
below them (a graph, not copies), and equal stacks are one node; where several ways lead to a node,
the one with the least (cost, audit) stays. That is exact: two ways of the same cost to the same place never have
audits of which one begins the other, as they differ in inserts only and those cost, so the least stays least
whatever follows.

A way is (cost, audit, made): the edits' initials and, for each edit, the symbol it gives ("-" for a deletion).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

#: system first if at all, then pairs of user and assistant; or nothing
PRODUCTIONS = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))
END = "$"
ROLES = {"u": "user", "a": "assistant"}  # symbols that an edit can make
KEEP, REROLE, DELETE, INSERT, UNDELETED_TRUNCATED = 0, 2, 3, 2, 1
Way = tuple[int, str, str]


@dataclass(frozen=True, eq=False)
class Node:
    """The top of a stack: an LR state and the node below it. Made by node(), so that equal stacks are the same object."""

    state: int
    below: Node | None


@lru_cache(maxsize=None)
def node(state: int, below: Node | None) -> Node:
    return Node(state, below)


class Tables:
    """SLR actions of a grammar; a state may have several for a symbol."""

    def __init__(self, productions=PRODUCTIONS):
        self.productions = [("^", productions[0][0]), *productions]
        self.heads = {h for h, _ in self.productions}
        self.follow = self._follow()
        self.states = [self._closure({(0, 0)})]
        self.moves: list[dict[str, int]] = []
        for state in self.states:  # grows while it is read
            after = {self.productions[p][1][dot] for p, dot in state if dot < len(self.productions[p][1])}
            self.moves.append({x: self._number(self._closure({(p, d + 1) for p, d in state if self.productions[p][1][d : d + 1] == x})) for x in sorted(after)})

    def _number(self, items: frozenset) -> int:
        if items not in self.states:
            self.states.append(items)
        return self.states.index(items)

    def _closure(self, items: Iterable) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            p, dot = todo.pop()
            following = self.productions[p][1][dot : dot + 1]
            new = {(k, 0) for k, (head, _) in enumerate(self.productions) if head == following} - items
            items |= new
            todo += new
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        empty = {h for h, body in self.productions if not body}
        first = {h: set() for h in self.heads}
        follow = {h: set() for h in self.heads} | {"^": {END}}
        while True:
            size = sum(map(len, [*first.values(), *follow.values()]))
            for head, body in self.productions:
                for x in body:
                    first[head] |= first.get(x, {x})
                    if x not in empty:
                        break
                behind = set(follow[head])
                for x in reversed(body):
                    if x in self.heads:
                        follow[x] |= behind
                    behind = first.get(x, {x}) | (behind if x in empty else set())
            if size == sum(map(len, [*first.values(), *follow.values()])):
                return follow

    def reductions(self, state: int, symbol: str) -> list[tuple[str, int]]:
        """(head, length of the body) of what can be reduced before `symbol`."""
        ended = [self.productions[p] for p, dot in sorted(self.states[state]) if p and dot == len(self.productions[p][1])]
        return [(head, len(body)) for head, body in ended if symbol in self.follow[head]]


TABLES = Tables()
START = node(0, None)


def _reduced(stack: Node, symbol: str) -> set[Node]:
    """The stack, and all that reductions before `symbol` make of it."""
    found, todo = {stack}, [stack]
    while todo:
        top = todo.pop()
        for head, n in TABLES.reductions(top.state, symbol):
            base = top
            for _ in range(n):
                base = base.below
            if head in TABLES.moves[base.state]:
                made = node(TABLES.moves[base.state][head], base)
                if made not in found:
                    found.add(made)
                    todo.append(made)
    return found


@lru_cache(maxsize=1 << 12)
def shifted(stack: Node, symbol: str) -> tuple[Node, ...]:
    """The stacks after reading `symbol`; none when no stack can."""
    tops = _reduced(stack, symbol)
    return tuple(node(TABLES.moves[t.state][symbol], t) for t in sorted(tops, key=_states) if symbol in TABLES.moves[t.state])


@lru_cache(maxsize=1 << 12)
def accepts(stack: Node) -> bool:
    """Whether the sequence may end here."""
    return any((0, 1) in TABLES.states[t.state] for t in _reduced(stack, END))


def _states(stack: Node | None) -> tuple[int, ...]:
    return () if stack is None else (*_states(stack.below), stack.state)


@lru_cache(maxsize=1)
def entries() -> tuple[Node, ...]:
    """All stacks that any sequence of roles can leave, in a fixed order."""
    found, todo = {START}, [START]
    while todo:
        stack = todo.pop()
        for made in (m for x in "sua" for m in shifted(stack, x)):
            if made not in found:
                found.add(made)
                todo.append(made)
    return tuple(sorted(found, key=_states))


def with_inserts(front: dict[Node, Way]) -> dict[Node, Way]:
    """The best way to each stack when symbols may be inserted here, cheapest first."""
    best = dict(front)
    heap = [(way, k, stack) for k, (stack, way) in enumerate(front.items())]
    heapq.heapify(heap)
    k = len(heap)
    while heap:
        way, _, stack = heapq.heappop(heap)
        if best[stack] != way:
            continue
        cost, audit, made = way
        for symbol in ROLES:
            for after in shifted(stack, symbol):
                new = (cost + INSERT, audit + "I", made + symbol)
                if after not in best or new < best[after]:
                    best[after] = new
                    heapq.heappush(heap, (new, k := k + 1, after))
    return best


def deleted(front: dict[Node, Way], n: int = 1) -> dict[Node, Way]:
    """n rows that have to go. Inserts before them never beat inserts behind them (D comes before I)."""
    return {stack: (cost + n * DELETE, audit + "D" * n, made + "-" * n) for stack, (cost, audit, made) in front.items()}


def after_row(front: dict[Node, Way], initial: str, truncated: bool) -> dict[Node, Way]:
    """The best way to each stack behind one row that may stay."""
    extra = UNDELETED_TRUNCATED if truncated else 0
    best: dict[Node, Way] = {}
    for old, (cost, audit, made) in with_inserts(front).items():
        ways = [(old, (cost + DELETE, audit + "D", made + "-"))]
        ways += [(m, (cost + KEEP + extra, audit + "K", made + initial)) for m in (shifted(old, initial) if initial else ())]
        ways += [(m, (cost + REROLE + extra, audit + "R", made + x)) for x in ROLES for m in shifted(old, x)]
        for stack, way in ways:
            if stack not in best or way < best[stack]:
                best[stack] = way
    return best


def ended(front: dict[Node, Way]) -> tuple[Node, Way]:
    """The best way to the end of the sequence, and the stack it ends with."""
    return min(((n, w) for n, w in with_inserts(front).items() if accepts(n)), key=lambda x: x[1])
