"""Rotations and frames as column arithmetic: six-number rotations, matrices, quaternions, gripper angles.

Each function nests its arguments many times over.  Give the result of one to
the next as ``elements`` of an array column, not as expressions, so that it is
computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def elements(array: str, n: int) -> list[Column]:
    """The first ``n`` elements of an array column."""
    return [F.get(F.col(array), F.lit(i)) for i in range(n)]


def dot(a: list[Column], b: list[Column]) -> Column:
    return sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def gram_schmidt(six: list[Column]) -> list[Column]:
    """A rotation matrix (nine numbers, by column) from two raw columns; null where they span no plane."""
    a, b = six[:3], six[3:]
    length = F.sqrt(dot(a, a))
    x = [F.when(length > 1e-9, c / length) for c in a]
    rest = [c - dot(x, b) * d for c, d in zip(b, x)]
    size = F.sqrt(dot(rest, rest))
    y = [F.when(size > 1e-9, c / size) for c in rest]
    return [*x, *y, *cross(x, y)]


def product(m: list[Column], n: list[Column]) -> list[Column]:
    """The product of two matrices given by column."""
    return [sum((m[3 * k + i] * n[3 * j + k] for k in (1, 2)), m[i] * n[3 * j]) for j in range(3) for i in range(3)]


def rotate(m: list, v: list[Column]) -> list[Column]:
    """A matrix (by column) times a vector."""
    return [v[0] * m[i] + v[1] * m[3 + i] + v[2] * m[6 + i] for i in range(3)]


def axis_matrix(axis: str, degrees: float) -> list[float]:
    """A constant rotation about one axis, by column; composed on the driver."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return {"x": [1, 0, 0, 0, c, s, 0, -s, c], "y": [c, 0, -s, 0, 1, 0, s, 0, c], "z": [c, s, 0, -s, c, 0, 0, 0, 1]}[axis]


def intrinsic(sequence: list[tuple[str, float]]) -> list[float]:
    """Constant rotations applied one after another about the turned axes."""
    out = [1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.0]
    for axis, degrees in sequence:
        n = axis_matrix(axis, degrees)
        out = [sum(out[3 * k + i] * n[3 * j + k] for k in range(3)) for j in range(3) for i in range(3)]
    return out


def quaternion(m: list[Column]) -> list[Column]:
    """``w, x, y, z`` of a rotation matrix by column; the largest component is found first."""
    e = lambda row, col: m[3 * col + row]
    a, b, c = e(0, 0), e(1, 1), e(2, 2)
    four = lambda v: F.sqrt(F.greatest(v, F.lit(0.0))) * 2
    cases = [
        (a + b + c > 0, four(a + b + c + 1), lambda s: [s / 4, (e(2, 1) - e(1, 2)) / s, (e(0, 2) - e(2, 0)) / s, (e(1, 0) - e(0, 1)) / s]),
        ((a >= b) & (a >= c), four(a - b - c + 1), lambda s: [(e(2, 1) - e(1, 2)) / s, s / 4, (e(0, 1) + e(1, 0)) / s, (e(0, 2) + e(2, 0)) / s]),
        (b >= c, four(b - a - c + 1), lambda s: [(e(0, 2) - e(2, 0)) / s, (e(0, 1) + e(1, 0)) / s, s / 4, (e(1, 2) + e(2, 1)) / s]),
        (c > b, four(c - a - b + 1), lambda s: [(e(1, 0) - e(0, 1)) / s, (e(0, 2) + e(2, 0)) / s, (e(1, 2) + e(2, 1)) / s, s / 4]),
    ]
    made = [(when, build(F.nullif(size, F.lit(0.0)))) for when, size, build in cases]
    out = []
    for k in range(4):
        value = F.lit(None).cast("double")
        for when, parts in reversed(made):
            value = F.when(when, parts[k]).otherwise(value)
        out.append(value)
    return out


def angle_between(p: list[Column], q: list[Column]) -> Column:
    """The turn in radians between two unit quaternions, whatever their signs."""
    return F.acos(F.least(F.lit(1.0), F.abs(dot(p, q)))) * 2


def gripper_distance(angle: Column, zero: Column, full: Column, reverse: Column, most_mm: float = 85.0) -> Column:
    """Opening in metres of a gripper from its magnet's angle in degrees.

    Linear between the closed and the open angle, open beyond it, and closed
    again past the middle of the rest of the turn; null where both are equal.
    """
    way = lambda a, b: F.pmod(F.when(reverse, a - b).otherwise(b - a), F.lit(360.0))
    span, gone = way(zero, full), way(zero, angle)
    opened = F.when(gone >= span + (360.0 - span) / 2, 0.0).when(gone > span, most_mm).otherwise(gone * most_mm / span)
    return F.when(span > 1e-8, F.least(F.greatest(opened, F.lit(0.0)), F.lit(most_mm)) / 1000.0)
