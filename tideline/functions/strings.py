"""String functions with the results a JVM stream job gives, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SIGNS = set(r"\^$.|?*+()[]{}")


def split_line(text: Column, separator: str = ",") -> Column:
    """Split on a regular expression and drop trailing empty parts.

    `""` gives one empty part, a text of separators only gives none.
    """
    if len(separator) == 1 and separator not in _REGEX_SIGNS:
        kept = F.rtrim(text, F.lit(separator))
        return F.when(
            (kept == "") & (text != ""), F.array().cast("array<string>")
        ).otherwise(F.split(kept, separator))
    parts = F.split(text, separator)
    filled = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.slice(parts, F.lit(1), filled))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units; characters beyond the basic plane count twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")


def string_hash(text: Column, factor: int = 1) -> Column:
    """The 31-polynomial string hash over UTF-16 units times `factor`, wrapped to 32 bits."""
    modulus = F.lit(2**32)

    def add(h: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        high = F.lit(0xD7C0) + F.shiftright(point, 10)
        low = F.lit(0xDC00) + point.bitwiseAND(F.lit(0x3FF))
        pair = ((h * 31 + high) % modulus) * 31 + low
        return F.when(point < 0x10000, h * 31 + point).otherwise(pair) % modulus

    letters = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    plain = F.aggregate(letters, F.lit(0).cast("bigint"), add)
    # shifted by half the modulus and back, the number wraps without being looked at twice
    half = F.lit(2**31)
    return (F.pmod(plain * F.lit(factor) + half, modulus) - half).cast("int")


def label(*parts: Column, separator: str) -> Column:
    """Parts joined as text, such as a window written `start$$$end`."""
    return F.concat_ws(separator, *[p.cast("string") for p in parts])
