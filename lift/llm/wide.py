"""Integers beyond 64 bits in columns: exact scores of vectors with huge components."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np

LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Holds the inner product of any two vectors of doubles with fewer than 2^64 components, quantised by up to 2^20.
BYTES = 272
MIDDLE = 1 << (8 * BYTES - 1)


def column_pair(score: int) -> tuple[int, bytes | None]:
    """The nearest long and, unless that is the score itself and not an end, bytes that sort like the score."""
    if LEAST < score < MOST:
        return score, None
    return max(LEAST, min(MOST, score)), (score + MIDDLE).to_bytes(BYTES, "big")


def whole(score: int, wide: bytes | None) -> int:
    return score if wide is None else int.from_bytes(wide, "big") - MIDDLE


def quantised(rows: list[list[float]], dims: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component, as whole Python numbers."""
    made = np.empty((len(rows), dims), object)
    for i, row in enumerate(rows):
        made[i] = [math.floor(scale * Fraction(x)) for x in row]
    return made
