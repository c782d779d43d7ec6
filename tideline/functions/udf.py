"""Functions under a name of the user's choice, callable from DataFrames and from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_string_hash(spark: SparkSession, name: str, factor: int) -> None:
    """SQL function `name(text)`: the string hash times `factor`, as a native expression."""
    modulus = 2**32
    point = "cast(ascii(c) as bigint)"
    pair = (
        f"(((h * 31 + 55232 + shiftright({point}, 10)) % {modulus}) * 31"
        f" + 56320 + ({point} & 1023))"
    )
    step = f"(case when {point} < 65536 then h * 31 + {point} else {pair} end) % {modulus}"
    letters = "case when text = '' then cast(array() as array<string>) else split(text, '') end"
    # shifted by half the modulus and back, the number wraps without being looked at twice
    shifted = f"aggregate({letters}, 0L, (h, c) -> {step}) * {factor}L + {2**31}L"
    spark.sql(
        f"create or replace temporary function {name}(text string) returns int return "
        f"cast(pmod({shifted}, {modulus}) - {2**31} as int)"
    )


def register_split(spark: SparkSession, name: str, separator: str = ",") -> None:
    """SQL table function `name(text)` giving (word, length) rows, for LATERAL joins.

    The rows are those of `split_line` for the regular expression, as native expressions.
    """
    pattern = separator.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"split(text, '{pattern}')"
    filled = f"array_max(transform({parts}, (x, i) -> case when x != '' then i + 1 else 0 end))"
    kept = f"case when text = '' then array('') else slice({parts}, 1, {filled}) end"
    spark.sql(
        f"create or replace temporary function {name}(text string) "
        "returns table(word string, length int) return "
        "select part, cast(octet_length(encode(part, 'UTF-16BE')) / 2 as int) "
        f"from explode({kept}) as words(part)"
    )


def register_average(spark: SparkSession, name: str) -> None:
    """SQL function `name(sum(x), count(x))`: the average of a group, null for no values.

    The accumulators are built-in aggregates, so groups of any size are added up before the shuffle.
    """
    spark.sql(
        f"create or replace temporary function {name}(total double, n bigint) returns double "
        "return total / nullif(n, 0)"
    )
