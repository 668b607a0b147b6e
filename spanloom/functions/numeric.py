"""Hashes, vectors, intervals and scores as Column expressions."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def unit_hash(c: Column) -> Column:
    """H1: the first eight bytes of the SHA-256 as a number in [0, 1)."""
    return (F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)") / F.lit(str(2**64)).cast("decimal(20,0)")).cast("double")


def stable_id(prefix: str, *parts: Column) -> Column:
    """A prefix and 24 digits of the hash of the parts."""
    return F.concat(F.lit(prefix + "-"), F.left(F.sha2(F.concat_ws("\u001f", *parts), 256), F.lit(24)))


def uuid5(namespace: str, name: Column) -> Column:
    """H4: the version 5 UUID of a name; namespace: 32 hexadecimal digits."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 8))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.right(variant, F.lit(1)), part(18, 3)), part(21, 12))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """H9; null for zero vectors."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_percent(a: Column, b: Column) -> Column:
    """The cosine mapped to 0..100."""
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), (cosine(a, b) + 1) / 2 * 100))


def normalized(a: Column) -> Column:
    """The unit vector; zero vectors stay."""
    n = F.sqrt(dot(a, a))
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def quantized(a: Column, top: Column) -> Column:
    """H8: components as tenths of a byte around zero, for the greatest magnitude of all vectors."""
    return F.transform(a, lambda x: F.rint(x.cast("double") / top * 127).cast("int"))


def wilson(successes: Column, total: Column, z: float = Z95) -> tuple[Column, Column]:
    """The Wilson interval of a share."""
    p, zz = successes / total, z * z
    centre = (p + zz / (2 * total)) / (1 + zz / total)
    half = z * F.sqrt(p * (1 - p) / total + zz / (4 * total * total)) / (1 + zz / total)
    return F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)


def stance(value: Column, reference: Column, tolerance: float = 0.25) -> Column:
    """A value within the tolerance of the mean magnitude supports the reference."""
    scale = (F.abs(value) + F.abs(reference)) / 2
    scale = F.when(scale == 0, 1.0).otherwise(scale)
    return F.when(value.isNull() | reference.isNull(), "inconclusive").when(F.abs(value - reference) / scale <= tolerance, "supporting").otherwise("conflicting")


def year_gap(a: Column, b: Column) -> Column:
    """99 where a year is unknown."""
    return F.coalesce(F.abs(a - b), F.lit(99))


def review_priority(risk: Column, ambiguity: Column, affected: Column) -> Column:
    """H18"""
    return F.round(risk * ambiguity * (1 + F.least(affected, F.lit(100)) / 10), 3)


def composite_score(accuracy: Column, tokens_per_second: Column, rss_mb: Column, throttled: Column) -> Column:
    """Half accuracy, three tenths speed up to 15 tokens a second, two tenths memory of 7 GiB, less heat."""
    memory = F.greatest(F.lit(0.0), 1 - rss_mb / (7 * 1024))
    return F.round(0.5 * accuracy + 0.3 * F.least(tokens_per_second / 15, F.lit(1.0)) + 0.2 * memory - F.when(throttled, 0.1).otherwise(0.0), 12)


def dcg_gain(relevance: Column, rank: Column) -> Column:
    """The share of one rank in the discounted gain."""
    return relevance / F.log2(rank + 1)


def close(a: Column, b: Column, relative: float = 1e-9) -> Column:
    """equal but for rounding."""
    return F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))


def iso_utc(at: Column) -> Column:
    """A time in ISO 8601, in UTC."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def elapsed_seconds(start: Column, stop: Column) -> Column:
    """Whole seconds between two times."""
    return F.floor((F.unix_micros(stop) - F.unix_micros(start)) / 1_000_000)


def percent_twin(number: Column) -> Column:
    """The same number as a share and as a percentage."""
    return F.array(number, number / 100, number * 100)


