"""Ranges joined to the points inside them, by a cover of the range with ranges of power-of-two length.

Points are numbered from 0 and belong to one *node* per level: at level ``l`` the point
``p`` lies in node ``p >> l``. A range of n points is the disjoint union of at most
``2 * log2(n)`` nodes, so a range is written as those nodes, a point as one node per
level, and both meet in an equi-join: each point of a range is met exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def levels_for(points: int) -> int:
    """Levels above 0 that ``points`` numbers need: the highest node holds all of them."""
    return max(0, points - 1).bit_length()


def point_nodes(point: Column, levels: int) -> Column:
    """The nodes that hold ``point``, one per level. A node's number tells its level as well."""
    return F.array(*[F.shiftright(point, n) + F.lit(1 << (levels - n)) for n in range(levels + 1)])


def range_nodes(first: Column, last: Column, levels: int) -> Column:
    """The nodes that together are ``first`` to ``last``, both included; none if a bound is NULL or they cross.

    Both bounds have to lie within the points. Of the nodes of a level that lie in the
    range, those whose parent does not are at its ends: an odd one on the left, an even
    one on the right.
    """
    nodes = []
    for n in range(levels + 1):
        begin = F.shiftright(first + F.lit((1 << n) - 1), n)
        end = F.shiftright(last + F.lit(1), n)
        number = F.lit(1 << (levels - n))
        nodes.append(F.when((begin < end) & (begin % 2 == 1), begin + number))
        nodes.append(F.when((begin < end) & (end % 2 == 1), end - 1 + number))
    return F.array_compact(F.when(first <= last, F.array(*nodes)))
