"""Scalar column functions: rounding, integer arithmetic, seeded hashing, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 2**32
EXACT_DOUBLE = float(2**52)


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_digits(c: Column | str, digits: int) -> Column:
    """Round half up to ``digits`` decimals. Doubles too large to have such decimals pass through."""
    c = column(c).cast("double")
    m = 10.0**digits
    rounded = F.floor(c * F.lit(m) + F.lit(0.5)) / F.lit(m)
    return F.when(F.abs(c) < F.lit(EXACT_DOUBLE / m), rounded).otherwise(c)


def round_significant(c: Column | str, digits: int) -> Column:
    """Round half up to ``digits`` significant digits; zero, NaN and infinities stay as they are."""
    c = column(c).cast("double")
    m = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(F.abs(c))))
    rounded = F.try_divide(F.floor(c * m + F.lit(0.5)).cast("double"), m)
    return F.when(c == 0, F.lit(0.0)).when(F.isnan(c) | (F.abs(c) == float("inf")), c).otherwise(rounded)


def integer_quotient(a: Column | str, b: Column | int) -> Column:
    """Quotient rounded down."""
    return F.floor(column(a) / b)


def ceil_quotient(a: Column | str, b: Column | int) -> Column:
    return F.ceil(column(a) / b)


def wrap_one_based(a: Column | str, n: Column | int) -> Column:
    """Map any integer into 1..n, keeping n itself."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(column(a) - 1, n) + 1


def seeded_hash(key: Column | str, seed: int | str) -> Column:
    """A 32-bit value per (key, seed), equal in any engine that has md5.

    The value depends on the key alone and not on a row's place, so a recomputed partition
    gets the same numbers; ``rand`` does not promise that after a shuffle.
    """
    text = F.concat(column(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def seeded_uniform(key: Column | str, seed: int | str) -> Column:
    """Uniform in (0, 1), never an end point."""
    return (seeded_hash(key, seed) + F.lit(0.5)) / F.lit(float(HASH_SPACE))


def seeded_normal(key: Column | str, seed: int | str) -> Column:
    """Standard normal by the Box-Muller transform of two seeded uniforms."""
    u = seeded_uniform(key, f"{seed}a")
    v = seeded_uniform(key, f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)


def gumbel_from_uniform(u: Column | str) -> Column:
    """Standard Gumbel quantile of ``u`` in (0, 1)."""
    return -F.log(-F.log(column(u)))


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-column(x)))


def relu(x: Column | str) -> Column:
    return F.greatest(column(x), F.lit(0.0))


def percent(x: Column | str) -> Column:
    return F.lit(100.0) * column(x)


def powers(c: Column | str, exponents) -> list[Column]:
    return [F.pow(column(c).cast("double"), F.lit(float(e))) for e in exponents]


def pad_right(c: Column | str, width: int) -> Column:
    """Fill with blanks on the right; longer text is kept whole."""
    c = column(c)
    return F.rpad(c, F.greatest(F.lit(width), F.length(c)), F.lit(" "))


def pad_left(c: Column | str, width: int) -> Column:
    c = column(c)
    return F.lpad(c, F.greatest(F.lit(width), F.length(c)), F.lit(" "))


def fixed_text(c: Column | str, digits: int) -> Column:
    """A number as text with ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", round_digits(c, digits))
