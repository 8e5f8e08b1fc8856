"""Text forms of values: cleaning, ISO times, base64, number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: every character a whitespace strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def nul() -> Column:
    return F.char(F.lit(0))


def strip(c: Column) -> Column:
    """Strip all Unicode whitespace; Spark's ``trim`` strips blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def drop_nul(c: Column) -> Column:
    return F.when(c.contains(nul()), F.replace(c, nul(), F.lit(""))).otherwise(c)


def escape_controls(c: Column) -> Column:
    """VAL-12: NUL removed, CR and LF written as two-character escapes."""
    no_cr = F.replace(drop_nul(c), F.lit("\r"), F.lit("\\r"))
    return F.replace(no_cr, F.lit("\n"), F.lit("\\n"))


def base64_text(c: Column) -> Column:
    """Base64 without the line breaks Spark inserts."""
    return F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))


def iso_time(c: Column, dtype: T.DataType) -> Column:
    """ISO-8601 text; microseconds only when there are any, offset only when zoned."""
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, ".SSSSSS")
    parts = [seconds, F.when(micros == ".000000", "").otherwise(micros)]
    if isinstance(dtype, T.TimestampType):
        parts.append(F.date_format(c, "xxx"))
    return F.concat(*parts)


def float_text(c: Column) -> Column:
    """Shortest round-trip text: plain digits for exponents -4..15, else ``1e+16``.

    Up to Java 18 a double beyond 2**53 may show a digit more than is needed; it
    still reads back as the same number.
    """
    java = c.cast("string")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    sign = F.when(java.startswith("-"), "-").otherwise("")
    mantissa = F.ltrim(F.substring_index(java, "E", 1), F.lit("-"))
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "(?<=.)0+$", "")
    whole = exponent + 1
    plain = F.when(
        F.length(digits) <= whole, F.concat(F.rpad(digits, whole, F.lit("0")), F.lit(".0"))
    ).otherwise(
        F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1))
    )
    lead = F.substr(digits, F.lit(1), F.lit(1))
    rest = F.substr(digits, F.lit(2))
    scientific = F.concat(
        lead,
        F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)),
        F.when(exponent > 0, "e+").otherwise("e-"),
        F.when(F.abs(exponent) < 10, "0").otherwise(""),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(c), "nan")
        .when(java == "Infinity", "inf")
        .when(java == "-Infinity", "-inf")
        .when(~java.contains("E"), java)
        .when(exponent.between(7, 15), F.concat(sign, plain))
        .when(exponent == -4, F.concat(sign, F.lit("0.000"), digits))
        .otherwise(F.concat(sign, scientific))
    )


def plain_text(c: Column, dtype: T.DataType) -> Column:
    """The text of a single value, as a string conversion gives it."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(dtype, T.FloatType):
        return float_text(c.cast("string").cast("double"))
    if isinstance(dtype, T.DoubleType):
        return float_text(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_time(c, dtype)
    if isinstance(dtype, T.BinaryType):
        return base64_text(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c)
    return c.cast("string")
