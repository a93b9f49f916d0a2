"""Viterbi search that gives out its decisions as soon as they are certain.

The best way to each state is the end of a path in a tree of backpointers. A node counts the nodes and
survivors that point to it and goes when the count is zero, so only the paths of the survivors are kept.
Once all of them pass through one node, everything up to it is decided: it is given out and the tree
starts there. Ways of equal cost are compared by the whole text of their undecided parts.

A state that could follow every way of another for a bounded extra cost outdoes it when it is cheaper by
more than that. Such survivors are dropped, as they would hold the tree back and cannot win, not even by a tie.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Mapping

Edge = tuple[Hashable, Hashable, int, str]


class Node:
    __slots__ = ("up", "label", "tag", "refs")

    def __init__(self, up: Node | None, label: str, tag: object) -> None:
        self.up, self.label, self.tag, self.refs = up, label, tag, 1
        if up is not None:
            up.refs += 1


class Survivors:
    """The cheapest way to each state, ties to the least text of its labels.

    Ways of one cost to one state must not be prefixes of each other; then the first difference decides,
    whatever follows. ``extra`` has, for (state, other), what the state needs at most beyond the cost of
    any way that the other has to the end.
    """

    def __init__(self, start: Hashable, extra: Mapping[tuple[Hashable, Hashable], int] | None = None) -> None:
        self.extra = extra or {}
        self.root = Node(None, "", None)
        self.best: dict[Hashable, tuple[int, Node]] = {start: (0, self.root)}

    def step(self, edges: Iterable[Edge], tag: object = None) -> list[tuple[object, str]]:
        """Follow one edge (from, to, cost, label) from every state; returns what is decided now.

        A decided step is (its tag and the state it started from, its label).
        """
        taken: dict[Hashable, tuple[int, Node, str, Hashable]] = {}
        for origin, to, cost, label in edges:
            if origin not in self.best:
                continue
            total, node = self.best[origin]
            total += cost
            rival = taken.get(to)
            if rival is None or total < rival[0] or total == rival[0] and before(node, label, rival[1], rival[2]):
                taken[to] = (total, node, label, origin)
        for (state, other), cost in self.extra.items():
            if state in taken and other in taken and taken[state][0] + cost < taken[other][0]:
                del taken[other]
        old = [node for _, node in self.best.values()]
        self.best = {to: (cost, Node(node, label, (tag, origin))) for to, (cost, node, label, origin) in taken.items()}
        for node in old:
            _release(node)
        return self._decided()

    def _decided(self) -> list[tuple[object, str]]:
        if self.root.refs > 1 or not self.best:
            return []
        leaves = [node for _, node in self.best.values()]
        path, node = [], leaves[0]
        while node is not self.root:
            path.append(node)
            node = node.up
        out = []
        for node in reversed(path):
            out.append((node.tag, node.label))
            self.root = node
            if node.refs > 1 or node in leaves:
                break
        self.root.up = None
        return out

    def ways(self) -> Iterator[tuple[Hashable, int, str]]:
        """For each state its cost and the undecided text that leads to it."""
        for state, (cost, node) in self.best.items():
            yield state, cost, "".join(reversed([n.label for n in _climb(node, self.root)]))

    def undecided(self) -> int:
        """The number of nodes that are kept."""
        return len({id(n) for _, node in self.best.values() for n in _climb(node, self.root)})


def _climb(node: Node, root: Node) -> Iterator[Node]:
    while node is not root:
        yield node
        node = node.up


def _release(node: Node | None) -> None:
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node = node.up


def before(a: Node, last_a: str, b: Node, last_b: str) -> bool:
    """Whether the labels to ``a`` and ``last_a`` are less than those to ``b`` and ``last_b``.

    Both nodes are as many steps from the root; the paths are compared from where they part.
    """
    left, right = [last_a], [last_b]
    while a is not b:
        left.append(a.label)
        right.append(b.label)
        a, b = a.up, b.up
    return "".join(reversed(left)) < "".join(reversed(right))
