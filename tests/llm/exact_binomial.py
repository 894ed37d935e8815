"""Exact binomial tails in rational arithmetic, for comparison."""

from fractions import Fraction
from math import comb, isclose


def tail(k, n, p):
    p = Fraction(p)
    if n > 20_000:
        return None
    return float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) if n <= 2000 else _floats(k, n, float(p))


def _floats(k, n, p):
    from math import exp, lgamma, log, log1p

    return sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)) for i in range(k + 1))


def upper_tail_ok(k, n, p, got):
    """The operator gives 1 where no cutoff could be admissible (k at or above the mean)."""
    if k >= n * p:
        return got == 1.0
    want = tail(k, n, p) if n <= 20_000 else _floats(k, n, p)
    return isclose(got, want, rel_tol=1e-7, abs_tol=1e-300)
