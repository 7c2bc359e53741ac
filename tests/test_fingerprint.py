"""The fingerprint against known digests and whole-number arithmetic."""

import random

from pyspark.sql import functions as F

from tessella.functions import fingerprint as P

M = (1 << 64) - 1


def by_integers(s: bytes) -> int:
    n = len(s)
    get = lambda i, k=8: int.from_bytes(s[i : i + k], "little")
    rot = lambda v, r: (v >> r | v << (64 - r)) & M
    by = (P.K2 + 2 * n) & M

    def mix(u, v):
        a = (u ^ v) * by & M
        a ^= a >> 47
        b = (v ^ a) * by & M
        return (b ^ b >> 47) * by & M

    if not n:
        return P.K2
    if n < 4:
        x = (s[0] + (s[n >> 1] << 8)) * P.K2 & M ^ (n + (s[-1] << 2)) * P.K0 & M
        return (x ^ x >> 47) * P.K2 & M
    if n < 8:
        return mix(n + (get(0, 4) << 3), get(n - 4, 4))
    if n <= 16:
        a, b = get(0) + P.K2 & M, get(n - 8)
        return mix(rot(b, 37) * by + a & M, (rot(a, 25) + b) * by & M)
    a, b, c, d = get(0) * (P.K1 if n <= 32 else P.K2) & M, get(8), get(n - 8) * by & M, get(n - 16) * P.K2 & M
    y = rot(a + b & M, 43) + rot(c, 30) + d & M
    z = mix(y, a + rot(b + P.K2 & M, 18) + c & M)
    if n <= 32:
        return z
    e, f, g, h = get(16) * by & M, get(24), (y + get(n - 32)) * by & M, (z + get(n - 24)) * by & M
    return mix(rot(e + f & M, 43) + rot(g, 30) + h & M, e + rot(f + a & M, 18) + g & M)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["f"] for r in df.select("i", P.fingerprint64(F.col("t")).alias("f")).orderBy("i").collect()]


def test_known_digests(spark):
    known = {"": -7286425919675154353, "1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}
    assert of(spark, list(known)) == list(known.values())


def test_every_length(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("0123456789-abcü漢") for _ in range(n)) for n in range(26) for _ in range(4)] + [f"{rnd.getrandbits(200):064x}"[:n] for n in range(65)]
    texts = [t for t in texts if len(t.encode()) <= 64]
    assert of(spark, texts) == [signed(by_integers(t.encode())) for t in texts]
    assert of(spark, ["x" * 65, None]) == [None, None]
    short = spark.createDataFrame([("x" * 16,), ("x" * 17,)], "t string").select(P.fingerprint64(F.col("t"), 16).alias("f")).collect()
    assert [r["f"] for r in short] == [signed(by_integers(b"x" * 16)), None]


def test_arithmetic(spark):
    rnd = random.Random(4)
    pairs = [(rnd.getrandbits(64), rnd.getrandbits(64)) for _ in range(50)] + [(M, M), (0, M), (1 << 63, 2), (1 << 32, 1 << 32), (0xFFFFFFFF, 0xFFFFFFFF)]
    df = spark.createDataFrame([(i, signed(a), signed(b)) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    a, b = F.col("a"), F.col("b")
    got = df.select("i", P.add(a, b, a), P.multiply(a, b), P.rotate(a, 37)).orderBy("i").collect()
    for (x, y), r in zip(pairs, got, strict=True):
        assert tuple(r)[1:] == (signed(2 * x + y & M), signed(x * y & M), signed((x >> 37 | x << 27) & M))
