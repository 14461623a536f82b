"""Recursive EMA as a blocked closed form (no recursion, no whole-series task).

y_t = a*x_t + q*y_{t-1}, q = 1 - a, seeded y_1 = x_1. Inside a block of B
rows that starts after carry c (the EMA at the previous block's last row):

    y_t = q^j * S_j + c * q^(j+1),   S_j = sum_{i<=j} w_i * x_i * q^(-i)

with w = a (w = 1 for the seed bar). S_j is a cumulative window sum over the
block. The carry is the previous block's local value at its last row; the
term it omits is scaled by q^B, which ``check_block`` requires to be below
1e-16 (under double rounding), and q^(-B) must stay far from overflow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def alpha_span(span: int) -> float:
    return 2.0 / (span + 1.0)


def alpha_wilder(n: int) -> float:
    return 1.0 / n


def check_block(alpha: float, block: int) -> None:
    q = 1.0 - alpha
    if q ** block >= 1e-16:
        raise ValueError(f"block {block} too short for alpha {alpha}: q^B = {q ** block:g}")
    if 2 * block * -math.log(q) > 600:  # sums over blocks use twice the length
        raise ValueError(f"block {block} too long for alpha {alpha}: q^-B overflows")


def local_term(x: Column, alpha: float, pos: Column, is_seed: Column,
               is_halo: Column) -> Column:
    """Per-row summand w*x*q^(-pos); halo rows contribute nothing."""
    q = 1.0 - alpha
    w = F.when(is_seed, F.lit(1.0)).otherwise(F.lit(alpha))
    return F.when(is_halo, F.lit(0.0)).otherwise(w * x * F.pow(F.lit(q), -pos.cast("double")))


def local_value(cum: Column, alpha: float, pos: Column) -> Column:
    """q^pos * S: the EMA contribution of the block's own rows."""
    return F.pow(F.lit(1.0 - alpha), pos.cast("double")) * cum


def with_carry(local: Column, carry: Column, alpha: float, pos: Column) -> Column:
    return local + F.coalesce(carry, F.lit(0.0)) * F.pow(F.lit(1.0 - alpha), pos.cast("double") + 1.0)
