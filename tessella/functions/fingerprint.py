"""The 64-bit fingerprint of the FarmHash family, for texts of up to 64 bytes, as column arithmetic.

Spark's long arithmetic refuses to overflow, so sums and products modulo 2^64
are formed from 32- and 16-bit halves.  Values that are used more than once are
bound by a one-element ``transform``; expressions would double in size at every
step otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the published algorithm
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F
_LOW = 0xFFFFFFFF


def _long(k: int) -> Column:
    return F.lit(k - (1 << 64) if k >> 63 else k).cast("long")


def _with(*values: Column, then: Callable[..., Column]) -> Column:
    """``then`` of the values, each evaluated once."""
    names = [f"v{i}" for i in range(len(values))]
    bound = F.struct(*[v.alias(n) for v, n in zip(values, names, strict=True)])
    return F.transform(F.array(bound), lambda s: then(*[s[n] for n in names]))[0]


def _low(a: Column) -> Column:
    return a.bitwiseAND(F.lit(_LOW).cast("long"))


def _high(a: Column) -> Column:
    return F.shiftrightunsigned(a, 32)


def add(*terms: Column) -> Column:
    """The sum modulo 2^64 of up to a few thousand terms."""

    def halves(*t: Column) -> Column:
        low, high = sum(map(_low, t[1:]), _low(t[0])), sum(map(_high, t[1:]), _high(t[0]))
        return _with(low, high, then=lambda low, high: F.shiftleft(high + F.shiftright(low, 32), 32).bitwiseOR(_low(low)))

    return _with(*terms, then=halves)


def multiply(a: Column, b: Column) -> Column:
    """The product modulo 2^64."""

    def low_half(x: Column, y: Column) -> Column:
        """The product of two 32-bit numbers modulo 2^32."""
        return _low(x * y.bitwiseAND(0xFFFF) + F.shiftleft((x * F.shiftright(y, 16)).bitwiseAND(0xFFFF), 16))

    def whole(a: Column, b: Column) -> Column:
        first, second = _low(a) * _low(b).bitwiseAND(0xFFFF), _low(a) * F.shiftright(_low(b), 16)
        cross = low_half(_high(a), _low(b)) + low_half(_high(b), _low(a))
        return _with(
            second, cross, then=lambda second, cross: _with(
                first + F.shiftleft(second.bitwiseAND(0xFFFF), 16), then=lambda low: F.shiftleft(F.shiftright(low, 32) + F.shiftright(second, 16) + cross, 32).bitwiseOR(_low(low))
            )
        )

    return _with(a, b, then=whole)


def rotate(a: Column, n: int) -> Column:
    return _with(a, then=lambda a: F.shiftrightunsigned(a, n).bitwiseOR(F.shiftleft(a, 64 - n)))


def _fold(a: Column) -> Column:
    return _with(a, then=lambda a: a.bitwiseXOR(F.shiftrightunsigned(a, 47)))


def _mix(u: Column, v: Column, by: Column) -> Column:
    def mixed(v: Column, by: Column) -> Column:
        first = _fold(multiply(u.bitwiseXOR(v), by))
        return multiply(_fold(multiply(v.bitwiseXOR(first), by)), by)

    return _with(v, by, then=mixed)


def _read(digits: Column, at: Column, size: int) -> Column:
    """``size`` bytes from byte ``at`` on of a hexadecimal text, the first one lowest."""
    pairs = [F.substr(digits, at * 2 + 1 + 2 * i, F.lit(2)) for i in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, -10).cast("long")


def fingerprint64(text: Column, longest: int = 64) -> Column:
    """The fingerprint as a signed long; null for null and for texts of more than ``longest`` (16, 32 or 64) bytes in UTF-8.

    The expression for 16 bytes, enough for an id and a seed, is much smaller.
    """

    def of(h: Column, n: Column) -> Column:
        zero = F.lit(0)
        whole = lambda i: _read(h, i if isinstance(i, Column) else F.lit(i), 8)
        length = n.cast("long")
        by = add(_long(K2), length * 2)
        byte = lambda i: _read(h, i, 1)

        to3 = multiply(
            _fold(multiply(byte(zero) + F.shiftleft(byte(F.shiftright(n, 1)), 8), _long(K2)).bitwiseXOR(multiply(length + F.shiftleft(byte(n - 1), 2), _long(K0)))), _long(K2)
        )
        to7 = _mix(length + F.shiftleft(_read(h, zero, 4), 3), _read(h, n - 4, 4), by)
        to16 = _with(
            by, add(whole(0), _long(K2)), whole(n - 8),
            then=lambda by, a, b: _mix(add(multiply(rotate(b, 37), by), a), multiply(add(rotate(a, 25), b), by), by),
        )

        def ends(a: Column, b: Column, c: Column, d: Column, by: Column, then: Callable[[Column, Column], Column]) -> Column:
            return then(add(rotate(add(a, b), 43), rotate(c, 30), d), add(a, rotate(add(b, _long(K2)), 18), c))

        to32 = _with(
            by, multiply(whole(0), _long(K1)), whole(8), then=lambda by, a, b: _with(
                multiply(whole(n - 8), by), multiply(whole(n - 16), _long(K2)), then=lambda c, d: ends(a, b, c, d, by, lambda u, v: _mix(u, v, by))
            )
        )

        def long(by: Column, a: Column, b: Column, c: Column, d: Column) -> Column:
            def second(y: Column, z: Column) -> Column:
                return _with(
                    multiply(whole(16), by), whole(24), multiply(add(y, whole(n - 32)), by), multiply(add(z, whole(n - 24)), by),
                    then=lambda e, f, g, h: _mix(add(rotate(add(e, f), 43), rotate(g, 30), h), add(e, rotate(add(f, a), 18), g), by),
                )

            return ends(a, b, c, d, by, lambda y, v: _with(y, v, then=lambda y, v: _with(_mix(y, v, by), then=lambda z: second(y, z))))

        to64 = _with(by, then=lambda by: _with(multiply(whole(0), _long(K2)), whole(8), multiply(whole(n - 8), by), multiply(whole(n - 16), _long(K2)), then=lambda a, b, c, d: long(by, a, b, c, d)))
        short = F.when(n == 0, _long(K2)).when(n < 4, to3).when(n < 8, to7).when(n <= 16, to16)
        return short if longest <= 16 else short.when(n <= 32, to32) if longest <= 32 else short.when(n <= 32, to32).when(n <= 64, to64)

    return _with(F.hex(F.encode(text, "UTF-8")), F.octet_length(text), then=of)
