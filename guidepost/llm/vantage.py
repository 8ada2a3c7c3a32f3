"""Vantage-point trees over 64-bit fingerprints under the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CANDIDATES = 6  # vantage points tried for a node
AT_ONCE = 1 << 20  # distances computed at a time


@dataclass
class Node:
    """An inner node has a vantage point: points within ``radius`` of it lie to the left."""

    leaf: int = -1
    vantage: np.uint64 = np.uint64(0)
    radius: int = 0
    left: Node | None = None
    right: Node | None = None


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def build(points: np.ndarray, leaf_size: int, reach: int) -> tuple[Node, int]:
    """A tree over distinct points and its number of leaves.

    A leaf has at most ``leaf_size`` points, or more where no vantage point parts them so that
    the boundary of width ``reach`` stays thin.
    """
    leaves = 0

    def grow(own: np.ndarray) -> Node:
        nonlocal leaves
        best = None
        if len(own) > leaf_size:
            for vantage in own[:: max(1, len(own) // CANDIDATES)][:CANDIDATES]:
                counts = np.bincount(distance(own, vantage), minlength=65).cumsum()
                left = counts[:65]
                seen = counts[np.minimum(np.arange(65) + reach, 64)]
                work = left * seen + (len(own) - left) ** 2.0
                radius = int(work.argmin())
                if best is None or work[radius] < best[0]:
                    best = (work[radius], vantage, radius)
        if best is None or best[0] > 0.9 * len(own) ** 2.0:
            leaves += 1
            return Node(leaf=leaves - 1)
        near = distance(own, best[1]) <= best[2]
        return Node(-1, best[1], best[2], grow(own[near]), grow(own[~near]))

    return grow(points), leaves


def route(tree: Node, points: np.ndarray, guest: np.ndarray, reach: int) -> Iterator[tuple]:
    """(leaf, numbers of points, which of them are guests) for every leaf that gets any.

    Every point that is no guest has one home leaf. Points of the right side that lie within
    ``reach`` of the left one also go there as guests, and guests go wherever the triangle
    inequality allows a point within ``reach``. So of two points within ``reach``, one meets the
    other in the other's home leaf.
    """
    stack = [(tree, np.arange(len(points)), guest)]
    while stack:
        node, at, visits = stack.pop()
        if not len(at):
            continue
        if node.leaf >= 0:
            yield node.leaf, at, visits
            continue
        far = distance(points[at], node.vantage)
        left = far <= node.radius + reach
        right = (far > node.radius) | (visits & (far > node.radius - reach))
        stack.append((node.left, at[left], visits[left] | (far[left] > node.radius)))
        stack.append((node.right, at[right], visits[right]))


def pairs_within(points: np.ndarray, guest: np.ndarray, reach: int) -> Iterator[tuple]:
    """Arrays of numbers (a, b) of points at most ``reach`` apart, not both of them guests.

    Brute force in blocks; in the order of the distance to the first point, the triangle
    inequality leaves a block only the points whose distance differs by at most ``reach``.
    """
    home = np.flatnonzero(~guest)
    if not len(home) or len(points) < 2:
        return
    far = distance(points, points[home[0]])
    order = np.argsort(far, kind="stable")
    ordered, own = far[order], home[np.argsort(far[home], kind="stable")]
    step = max(1, AT_ONCE // len(points))
    for i in range(0, len(own), step):
        block = own[i : i + step]
        lo = np.searchsorted(ordered, far[block[0]] - reach)
        hi = np.searchsorted(ordered, far[block[-1]] + reach, "right")
        others = order[lo:hi]
        a, b = np.nonzero(distance(points[block][:, None], points[others][None, :]) <= reach)
        a, b = block[a], others[b]
        keep = guest[b] | (a < b)
        yield a[keep], b[keep]
