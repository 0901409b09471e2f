"""How values print: null and empty rules, names and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as white space when content is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def present(value: Column) -> Column:
    """The value, with an empty string read as absent."""
    return F.nullif(value, F.lit(""))


def optional_text(value: str | Column | None) -> Column:
    """A literal or column as a string column; None is a null string."""
    return value if isinstance(value, Column) else F.lit(value).cast("string")


def printed(value: Column) -> Column:
    """A string as a template prints it: null becomes the word None."""
    return F.coalesce(value, F.lit("None"))


def stripped(value: Column) -> Column:
    """The text without white space at either end (plain `trim` removes spaces only)."""
    return F.btrim(value, F.lit(WHITESPACE))


def printed_double(value: Column) -> Column:
    """A double in shortest-repr spelling: plain digits from 1e-4 up to 1e16, else `d.ddde+XX`.

    The JVM spells 12345678.0 as 1.2345678E7, so digits and exponent are taken from that
    spelling and put together again. Before Java 19 the JVM sometimes writes one digit more
    than needed to tell a double apart; such a value prints with that digit.
    """
    spelled = F.abs(value).cast("string")
    digits = F.regexp_replace(F.split_part(spelled, F.lit("E"), F.lit(1)), r"\.0$", "")
    digits = F.replace(digits, F.lit("."), F.lit(""))
    power = F.split_part(spelled, F.lit("E"), F.lit(2)).try_cast("int")
    whole = power + 1
    plain = (
        F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -whole), digits))
        .when(F.length(digits) <= whole, F.concat(F.rpad(digits, whole, "0"), F.lit(".0")))
        .otherwise(F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1)))
    )
    mantissa = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""),
    )
    scientific = F.concat(
        mantissa,
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"),
    )
    unsigned = (
        F.when(power.isNull(), spelled).when((power >= -4) & (power < 16), plain).otherwise(scientific)
    )
    # A negative zero keeps its sign, which a comparison with 0 would lose.
    sign = F.when(F.startswith(value.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(value.isNull() | F.isnan(value), F.lit("nan"))
        .when(F.abs(value) == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
        .otherwise(F.concat(sign, unsigned))
    )


def as_text(value: Column, data_type: T.DataType, numeric_null: str = "nan") -> Column:
    """Any scalar as prompt text. A null prints None, or `numeric_null` in a numeric column."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise ValueError(f"A column of type {data_type.simpleString()} cannot be used as prompt text")
    if isinstance(data_type, T.StringType):
        return printed(value)
    if isinstance(data_type, T.BooleanType):
        return printed(F.initcap(value.cast("string")))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(value.isNull(), numeric_null).otherwise(printed_double(value.cast("double")))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(value.cast("string"), F.lit(numeric_null))
    return printed(value.cast("string"))


def sanitized_name(name: Column, replace_dots: bool = False) -> Column:
    """Last path segment in lower case, with spaces and colons (and dots) as hyphens."""
    last = F.element_at(F.split(name, "/"), -1)
    return F.lower(F.translate(last, " :.", "---") if replace_dots else F.translate(last, " :", "--"))


def commit_hash(checksum_url: Column) -> Column:
    """The revision in a checksum URL, between its first `@` and the next `/`; null without one."""
    return present(F.split_part(F.split_part(checksum_url, F.lit("@"), F.lit(2)), F.lit("/"), F.lit(1)))
