"""Sums of doubles that do not depend on their order.

A double is an integer times a power of two.  Exponents are cut into bands of four; within a band all
doubles are integers of at most 58 bits in one unit, whose sums are exact decimals.  A total is a short
list of bands, at most 526 for all doubles there are; it is rounded once, to the nearest double.
"""

from __future__ import annotations

BAND_BITS = 4
"""Narrow enough for the integers to fit the 18 digits of a short decimal."""


def quoted(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def is_finite(x: str) -> str:
    return f"abs({x}) < double('Infinity')"


def _exponent(x: str) -> str:
    # The logarithm may be off by one; one bit more than a double has makes up for it.
    return f"(int(floor(log2(abs({x})))) - 53)"


def band(x: str) -> str:
    """SQL of the band of a finite double other than zero, else NULL."""
    return (
        f"CASE WHEN {is_finite(x)} AND {x} <> 0"
        f" THEN int(floor({_exponent(x)} / {BAND_BITS})) END"
    )


def units(x: str) -> str:
    """SQL of the double in the unit of its band, as exact decimal; NULL where :func:`band` is."""
    e = _exponent(x)
    whole = f"bigint({x} * power(2D, -({e} div 2)) * power(2D, {e} div 2 - {e}))"
    shift = f"shiftleft(1L, {e} - {BAND_BITS} * int(floor({e} / {BAND_BITS})))"
    return (
        f"CASE WHEN {is_finite(x)} AND {x} <> 0"
        f" THEN CAST({whole} * {shift} AS decimal(18,0)) END"
    )


def total(bands: str, amount: str) -> str:
    """SQL of the double nearest to the sum that a list of bands stands for.

    ``bands`` is an array of structs with the field ``band``; ``amount`` is SQL of an element ``x``.
    From the lowest band up, what exceeds a band is carried into the next, so the sum becomes digits to the
    base 16 below a carry.  From the highest down, digits are put behind the carry until it has a
    hundred bits; of the others only the sign of the first matters, which is put behind as well.
    The one conversion of that to a double is the only rounding.
    """
    amount = f"coalesce({amount}, 0)"
    whole = "decimal(38,0)"

    def once(value: str, name: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    here = (
        f"CAST(s.c + aggregate(filter(l, x -> x.band = b), CAST(0 AS {whole}),"
        f" (a, x) -> CAST(a + {amount} AS {whole})) AS {whole})"
    )
    digit = (
        f"named_struct('c', CAST((t - t % 16) * 0.0625 AS {whole}),"
        f" 'd', concat(s.d, array(CAST(t % 16 AS {whole}))))"
    )
    digits = (
        f"aggregate(sequence(k.lo, k.hi),"
        f" named_struct('c', CAST(0 AS {whole}), 'd', CAST(array() AS array<{whole}>)),"
        f" (s, b) -> {once(here, 't', digit)})"
    )
    top = (
        f"aggregate(reverse(d.d), named_struct('m', d.c, 'n', 0, 'z', 0), (s, r) ->"
        f" CASE WHEN abs(s.m) < {1 << 100} THEN"
        f" named_struct('m', CAST(s.m * 16 + r AS {whole}), 'n', s.n + 1, 'z', 0)"
        " ELSE named_struct('m', s.m, 'n', s.n, 'z', CASE WHEN s.z <> 0 THEN s.z ELSE int(sign(r)) END) END)"
    )
    scaled = (
        f"double(CAST(f.m * 2 + f.z AS {whole})) * power(2D, e div 2) * power(2D, e - e div 2)"
    )
    value = once(
        digits,
        "d",
        once(top, "f", once(f"{BAND_BITS} * (k.hi + 1 - f.n) - 1", "e", scaled)),
    )
    bounds = "named_struct('lo', int(array_min(l.band)), 'hi', int(array_max(l.band)))"
    return once(
        f"filter({bands}, x -> {amount} <> 0)",
        "l",
        f"CASE WHEN size(l) > 0 THEN {once(bounds, 'k', value)} ELSE 0D END",
    )
