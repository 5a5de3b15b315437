"""Exact inner products of integer vectors by float32 matrix products in a residue number system.

A float32 product of small integers is exact while every partial sum stays below 2^24. So the vectors are
taken modulo several small primes, with residues around zero, and multiplied modulo each prime; sums run over at most
``INNER`` components at once. The products modulo the primes fix the score by the Chinese remainder theorem, in mixed
radix form, as long as the primes' product exceeds the range of scores.
"""

from __future__ import annotations

import math

import numpy as np

#: Components in one float32 product.
INNER = 256
#: Scores beyond this could not be ranked together with a row's place in one 64-bit number.
MAX_SCORE = 1 << 50


def primes_below(limit: int):
    """Odd primes up to the limit, largest first."""
    for n in range(limit - 1 + limit % 2, 2, -2):
        if all(n % k for k in range(3, math.isqrt(n) + 1, 2)):
            yield n


def moduli(dims: int, largest: int) -> list[int]:
    """As many primes as scores between -largest and largest need, each small enough for exact sums."""
    if largest > MAX_SCORE:
        raise ValueError(f"inner products up to {largest} pass {MAX_SCORE}: use a smaller scale")
    half = math.isqrt((1 << 24) // max(1, min(dims, INNER)))
    chosen: list[int] = []
    for p in primes_below(2 * min(half, 512) + 1):
        if chosen and math.prod(chosen) > 2 * largest:
            break
        chosen.append(p)
    return chosen


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The integer matrix modulo each prime, between -(p-1)/2 and (p-1)/2, in float32."""
    out = []
    for p in primes:
        r = vectors % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two matrices that are given by their residues."""
    total, radix = None, 1
    for x, y, p in zip(a, b, primes, strict=True):
        r = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], INNER):
            r += (x[:, at : at + INNER] @ y[:, at : at + INNER].T).astype(np.int32) % p
        if total is None:
            total = r % p
        else:  # the next digit: what is missing to the residue, over the radix
            total += radix * ((r - total) % p * pow(radix, -1, p) % p)
        radix *= p
    total[total > radix // 2] -= radix
    return total
