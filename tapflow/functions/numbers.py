"""Rounding and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Binary half-even rounding of a double, as numeric Python libraries round."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def joined_key(columns: list[Column], sep: str = "_") -> Column:
    """Text key of several columns; NULL as soon as one part is NULL."""
    if not columns:
        raise ValueError("a key needs at least one column")
    parts: list[Column] = []
    for i, column in enumerate(columns):
        if i:
            parts.append(F.lit(sep))
        parts.append(column.cast("string"))
    return F.concat(*parts)


def text_to_id(text: Column) -> Column:
    """Text to BIGINT or NULL; never raises."""
    return F.trim(text).try_cast("bigint")


# Hart's rational approximation of the normal tail (West, 2005), highest power first.
_TAIL_UP = [0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376]
_TAIL_DOWN = [
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]


def _polynomial(x: Column, factors: list[float]) -> Column:
    out = F.lit(factors[0])
    for factor in factors[1:]:
        out = out * x + F.lit(factor)
    return out


def normal_cdf(x: Column) -> Column:
    """Share of a standard normal below ``x``, to about fifteen digits."""
    far = F.abs(x)
    bell = F.exp(-far * far / 2)
    fraction = far + 1 / (far + 2 / (far + 3 / (far + 4 / (far + 0.65))))
    tail = F.when(far > 37, 0.0).when(far < 7.07106781186547, bell * _polynomial(far, _TAIL_UP) / _polynomial(far, _TAIL_DOWN)).otherwise(bell / fraction / 2.506628274631)
    return F.when(x > 0, 1 - tail).otherwise(tail)
