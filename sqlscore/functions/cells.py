"""Canonical cell encoding for comparing query results across column types.

A result row becomes ``array<string>`` of tagged cells so rows from queries
with different column types compare the way the scoring rule expects:
numbers compare by value (``1 == 1.0``), NULL equals NULL, ``1 != '1'``.

* NULL → NULL element
* numbers → ``n:<sign><digits>e<exponent>``, the shortest decimal form: digits
  without zeros at either end, so equal values of any numeric type agree and
  no digit is lost (``1``, ``1.0`` and ``1e0`` are ``n:1e0``)
* booleans → the numbers 1 and 0 (True == 1 in the rule's host language)
* strings → ``s:<text>``; binary → ``b:<hex>``; dates/timestamps → ``t:<iso>``
* anything else (arrays, maps, structs) → ``j:<json>``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _number(text: Column) -> Column:
    """``<sign><digits>e<exponent>`` of a printed number (plain or with an exponent)."""
    low = F.lower(text)
    sign = F.when(low.startswith("-"), "-").otherwise("")
    body = F.regexp_replace(F.substring_index(low, "e", 1), "^[+-]", "")
    power = F.when(low.contains("e"), F.substring_index(low, "e", -1)).otherwise("0").try_cast("int")
    whole = F.substring_index(body, ".", 1)
    part = F.when(body.contains("."), F.substring_index(body, ".", -1)).otherwise("")
    digits = F.ltrim(F.concat(whole, part), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    exponent = power - F.length(part) + F.length(digits) - F.length(kept)
    return (F.when(power.isNull() | ~body.rlike("^[0-9]"), text)  # NaN, Infinity
            .when(kept == "", F.lit("0e0"))
            .otherwise(F.concat(sign, kept, F.lit("e"), exponent.cast("string"))))


def _integer(text: Column) -> Column:
    """:func:`_number` of a printed integer: no point, no exponent, no zeros in front."""
    digits = F.ltrim(text, F.lit("-"))
    kept = F.rtrim(digits, F.lit("0"))
    exponent = F.length(digits) - F.length(kept)
    return F.when(kept == "", F.lit("0e0")).otherwise(
        F.concat(F.when(text.startswith("-"), "-").otherwise(""), kept, F.lit("e"), exponent.cast("string")))


def cell(c: Column, dtype: T.DataType) -> Column:
    """Tagged string for one value of type ``dtype``."""
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.concat(F.lit("n:"), _integer(c.cast("int").cast("string")))
    if isinstance(dtype, T.FloatType):
        return F.concat(F.lit("n:"), _number(c.cast("double").cast("string")))
    if isinstance(dtype, _INTEGRAL):
        return F.concat(F.lit("n:"), _integer(c.cast("string")))
    if isinstance(dtype, (T.DoubleType, T.DecimalType)):
        return F.concat(F.lit("n:"), _number(c.cast("string")))  # a double prints its shortest round-trip form
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return F.concat(F.lit("s:"), c.cast("string"))
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("b:"), F.hex(c))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit("t:"), c.cast("string"))
    return F.concat(F.lit("j:"), F.to_json(F.struct(c.alias("v"))))


def row_cells(df: DataFrame) -> Column:
    """``array<string>`` of canonical cells for every column of ``df`` (by position)."""
    return F.array(*[cell(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]) if df.columns \
        else F.array().cast("array<string>")
