"""Cover tree for inner products over norm-augmented vectors, searched best first by blocks of queries.

Every vector x gets the coordinate sqrt(M^2 - |x|^2), so all lie on a sphere of radius M and the inner product with a
query (0 there) falls as the angle to it grows.  A node has a centre and a covering radius: every vector below it lies
within that radius, which halves from level to level; centres of one node's children lie further apart than the
children's radius.  With the angles of query and radius, the inner products below a node lie between
|q| M cos(angle + reach) and |q| M cos(angle - reach).  The bounds are widened by ``SLACK``, as they are floating-point;
leaves are decided by the exact integer products.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

LEAF = 64
SLACK = 1e-6
EXACT = float(1 << 53)


def products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products of rows of whole numbers; exact beyond the range of doubles too."""
    if largest < EXACT:
        return (a @ b.T).astype(np.int64)
    x, y = (np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (a, b))
    return np.array(x @ y.T, np.int64).reshape(len(a), len(b))


@dataclass
class Node:
    centre: int
    members: np.ndarray
    reach: float = 0.0  # largest angle from the centre to a member
    children: list[Node] = field(default_factory=list)


class CoverTree:
    """Tree over the rows of ``vectors`` (whole numbers as doubles); ``radius`` is at least the largest norm."""

    def __init__(self, vectors: np.ndarray, radius: float) -> None:
        self.vectors, self.radius = vectors, radius
        extra = np.sqrt(np.maximum(radius**2 - (vectors**2).sum(1), 0))
        self.points = np.column_stack([vectors, extra]) / (radius or 1.0)
        self.root = self._grow(0, np.arange(len(vectors)), 2.0)

    def _angles(self, centre: int, members: np.ndarray) -> np.ndarray:
        return 2 * np.arcsin(np.clip(np.linalg.norm(self.points[members] - self.points[centre], axis=1) / 2, 0, 1))

    def _grow(self, centre: int, members: np.ndarray, radius: float) -> Node:
        """The node of ``members``, all within ``radius`` of the centre; a level halves the radius."""
        stack = [(root := Node(centre, members), radius)]
        while stack:
            node, r = stack.pop()
            apart = np.linalg.norm(self.points[node.members] - self.points[node.centre], axis=1)
            node.reach = float(2 * np.arcsin(min(1.0, apart.max() / 2)))
            if len(node.members) <= LEAF or apart.max() <= SLACK:
                continue
            while r / 2 >= apart.max():  # levels at which the node would have itself as its only child
                r /= 2
            r /= 2
            left, first = node.members, node.centre
            while len(left):
                near = np.linalg.norm(self.points[left] - self.points[first], axis=1) <= r
                if len(node.children) >= LEAF and near.sum() * 4 < LEAF:  # what is left lies too far apart for a net: one leaf, by its own reach
                    node.children.append(rest := Node(int(left[0]), left))
                    rest.reach = float(self._angles(rest.centre, left).max())
                    break
                node.children.append(Node(int(first), left[near]))
                left = left[~near]
                first = left[0] if len(left) else None
                stack.append((node.children[-1], r))
        return root

    def search(self, queries: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, take) -> None:
        """Give ``take(leaf members, query numbers, products)`` every leaf that may hold a product in a query's window.

        ``low`` and ``high`` are the windows (inclusive); ``take`` may raise ``low``.  Nodes go by their best bound.
        """
        scale = norms * self.radius
        near = np.where(scale > 0, scale, 1.0)

        def bounds(node: Node, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            angle = np.arccos(np.clip(queries[which] @ self.vectors[node.centre] / near[which], -1, 1))
            wide = SLACK * scale[which] + SLACK
            return (scale[which] * np.cos(np.minimum(angle + node.reach, np.pi)) - wide, scale[which] * np.cos(np.maximum(angle - node.reach, 0)) + wide)

        def push(node: Node, which: np.ndarray) -> None:
            nonlocal order
            least, most = bounds(node, which)
            may = (most >= low[which]) & (least <= high[which])
            if may.any():
                order += 1
                heapq.heappush(heap, (-float((most[may] / near[which][may]).max()), order, node, which[may], most[may]))

        heap: list = []
        order = 0
        if len(queries) and len(self.vectors):
            push(self.root, np.arange(len(queries)))
        while heap:
            _, _, node, which, most = heapq.heappop(heap)
            which = which[most >= low[which]]  # windows may have closed since
            if not len(which):
                continue
            if node.children:
                for child in node.children:
                    push(child, which)
            else:
                largest = float(norms[which].max() * self.radius)
                take(node.members, which, products(queries[which], self.vectors[node.members], largest))
