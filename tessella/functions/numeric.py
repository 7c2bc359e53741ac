"""Native numeric and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.fingerprint import fingerprint64


def split_score(seed: str, ident: Column) -> Column:
    """A number in [0, 1) from 60 bits of SHA-256 of ``seed:id``."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident.cast("string")), 256), 1, 15), 16, 10).cast("double") / F.lit(float(16**15))


def tie_key(ident: Column, seed: int | str) -> Column:
    """A stable pseudo-random order."""
    return F.md5(F.concat(ident.cast("string"), F.lit(f"-{seed}")))


def fingerprint_key(ident: Column, seed: int | str) -> Column:
    """The order by the fingerprint of ``id-seed``, of 16 bytes at most; longer ones are an error."""
    text = F.concat(ident.cast("string"), F.lit(f"-{seed}"))
    return F.when(F.octet_length(text) > 16, F.raise_error(F.lit("id and seed are longer than 16 bytes")).cast("long")).otherwise(fingerprint64(text, 16))


def seed_of(c: Column) -> Column:
    """A 32-bit seed: the first eight hexadecimal digits of the SHA-256 of a text."""
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 8), 16, 10).cast("long")


def split_of(score: Column, train: float, val: float) -> Column:
    if not (0 < train < 1 and 0 <= val and train + val < 1):
        raise ValueError("fractions must be positive and leave room for a test part")
    return F.when(score < train, "train").when(score < train + val, "val").otherwise("test")


def severity(c: Column) -> Column:
    """Four bins at 30, 40 and 50."""
    return F.when(c < 30, "severe").when(c < 40, "moderate").when(c < 50, "mild").when(c >= 50, "normal")


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null where ``b`` is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def best_of(names: list[str], values: list[Column], largest: bool = True) -> Column:
    """The name of the best value, the earlier name at ties; null where any value is missing."""
    best = F.greatest(*values) if largest else F.least(*values)
    out = F.lit(None).cast("string")
    for name, value in reversed(list(zip(names, values, strict=True))):
        out = F.when(value == best, F.lit(name)).otherwise(out)
    missing = values[0].isNull()
    for v in values[1:]:
        missing |= v.isNull()
    return F.when(~missing, out)


def elapsed_seconds(c: Column) -> Column:
    """Seconds of a process time ``[[days-]hours:]minutes:seconds``; null for anything else."""
    part = lambda i: F.coalesce(F.regexp_extract(c, r"^(?:(?:(\d+)-)?(\d+):)?(\d+):(\d+)$", i).try_cast("long"), F.lit(0))
    return F.when(c.rlike(r"^(?:(?:\d+-)?\d+:)?\d+:\d+$"), ((part(1) * 24 + part(2)) * 60 + part(3)) * 60 + part(4))


def eta_seconds(done: Column, total: Column, elapsed: Column) -> Column:
    """Seconds left at the rate so far; null before anything is done."""
    return ratio(elapsed * (total - done), done)
