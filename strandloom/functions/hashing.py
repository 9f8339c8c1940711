"""Hashes that other systems must be able to recompute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utf16_units(text: Column | str) -> Column:
    """The UTF-16 code units of a text, as an array of numbers."""
    codes = F.hex(F.encode(_col(text), "UTF-16BE"))
    count = (F.length(codes) / 4).cast("int")
    at = lambda i: F.conv(F.substring(codes, i * 4 - 3, F.lit(4)), 16, 10).cast("long")
    return F.when(count == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), count), at))


def h32(text: Column | str) -> Column:
    """32-bit FNV-1a over UTF-16 code units, as a long. Null gives null."""
    step = lambda h, c: (h.bitwiseXOR(c) * F.lit(16777619)).bitwiseAND(F.lit(4294967295))
    return F.aggregate(utf16_units(text), F.lit(2166136261).cast("long"), step)


def string_hash(text: Column | str) -> Column:
    """The signed 32-bit hash ``31 h + c`` over UTF-16 code units."""
    step = lambda h, c: (h * 31 + c).bitwiseAND(F.lit(4294967295))
    unsigned = F.aggregate(utf16_units(text), F.lit(0).cast("long"), step)
    return F.when(unsigned >= 2147483648, unsigned - 4294967296).otherwise(unsigned)


def jitter(id: Column | str) -> Column:
    """A fixed offset in [-0.0005, 0.0005) for an id, to part ties."""
    unsigned = F.pmod(string_hash(id), F.lit(4294967296))
    return ((unsigned % 1000) / 1000.0 - 0.5) * 0.001


def content_key(text: Column | str) -> Column:
    """SHA-256 of a text, hexadecimal: the key of embedding and answer caches."""
    return F.sha2(_col(text), 256)


def holdout(source: Column | str, raw: Column | str) -> Column:
    """Whether a seed pair is held out: one in five, by hash."""
    return h32(F.concat(_col(source), F.lit("|"), _col(raw))) % 5 == 0


def vector_signature(vector: Column | str) -> Column:
    """The first 16 numbers with 3 decimals: equal for vectors that are the same for all purposes."""
    return F.array_join(F.transform(F.slice(_col(vector), 1, 16), lambda x: F.format_string("%.3f", F.round(x.cast("double"), 3) + 0.0)), ",")
