"""Logical types, their target types and the parsing rules used to infer them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Target types a logical source type may land in (prefix match).
COMPATIBLE = {
    "STRING": ["VARCHAR", "STRING", "TEXT", "CHAR"],
    "LONG": ["NUMBER", "INTEGER", "BIGINT", "INT"],
    "DOUBLE": ["FLOAT", "DOUBLE", "DECIMAL", "NUMERIC"],
    "DATETIME": ["TIMESTAMP", "DATETIME", "DATE"],
}

# Staging cast type of a logical type; anything else is text.
CAST_TYPES = {
    "DATETIME": "timestamp",
    "DATE": "timestamp",
    "TIMESTAMP": "timestamp",
    "DOUBLE": "float",
    "DECIMAL": "float",
    "LONG": "number",
    "STRING": "varchar(16777216)",
    "TEXT": "text",
}
CAST_FALLBACK = "varchar(16777216)"

# Declared type names and the Spark type they stand for; anything else is text.
DECLARED_TYPES = {
    "string": ["TEXT", "VARCHAR", "STRING", "CHAR"],
    "bigint": ["INT", "INTEGER", "BIGINT"],
    "double": ["NUMBER", "DECIMAL", "FLOAT", "DOUBLE"],
    "timestamp_ntz": ["DATE", "DATETIME", "TIMESTAMP", "TIMESTAMP_NTZ"],
    "boolean": ["BOOLEAN", "BOOL"],
}

# Name parts that mark a numeric-looking text column as numeric.
NUMERIC_KEYWORDS = [
    "id", "count", "amount", "price", "quantity", "number", "total",
    "threshold", "value", "rate", "percent", "score", "metric",
    "weight", "size", "length", "width", "height", "volume",
    "cost", "revenue", "profit", "margin", "ratio", "factor",
]

# Text forms of a boolean.
TRUE_TEXT = ["true", "1", "yes"]
FALSE_TEXT = ["false", "0", "no"]

NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
DATETIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
US_DATE_PATTERN = r"^([0-9]{2})/([0-9]{2})/([0-9]{4})$"


def as_double(c: Column) -> Column:
    """Number held by a text, NULL when it is not one (NaN text included)."""
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def as_long(c: Column) -> Column:
    """Whole number held by a text; fractions and overflow become NULL."""
    number = as_double(c)
    exact = F.trim(c).try_cast("bigint")
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), exact).otherwise(
        F.when(number == F.floor(number), number.try_cast("bigint"))
    )


# Further forms of dates and times, each with the pattern that it is read by.
DATE_FORMS = [
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2}$", "M/d/yyyy H:mm:ss"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}$", "M/d/yyyy H:mm"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
    (r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
]
ZONED_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})$"


def as_timestamp(c: Column) -> Column:
    """A date or time in ISO form, month/day/year, or one of ``DATE_FORMS`` as a timestamp, else NULL.

    A time with a zone becomes the time in UTC.
    """
    text = F.trim(c)
    iso = F.when(text.rlike(DATETIME_PATTERN), text)
    us = F.when(text.rlike(US_DATE_PATTERN), F.regexp_replace(text, US_DATE_PATTERN, "$3-$1-$2"))
    plain = F.coalesce(iso, us).try_cast("timestamp_ntz")
    instant = F.when(text.rlike(ZONED_PATTERN), text).try_cast("timestamp").cast("timestamp_ntz")
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant)
    # Read in the session's zone and shown in it again: the local time stays as written.
    others = [F.when(text.rlike(p), F.try_to_timestamp(F.initcap(text), F.lit(f)).cast("timestamp_ntz")) for p, f in DATE_FORMS]
    return F.coalesce(plain, zoned, *others)


def as_boolean(c: Column) -> Column:
    text = F.lower(c)
    return F.when(text.isin(TRUE_TEXT), True).when(text.isin(FALSE_TEXT), False)


def types_compatible(left_type: Column, right_type: Column) -> Column:
    """Whether a logical type fits a target type; unknown logical types fit anything."""
    fits = F.lit(True)
    for logical, targets in COMPATIBLE.items():
        pattern = "^(" + "|".join(targets) + ")"
        fits = F.when(left_type == logical, F.upper(right_type).rlike(pattern)).otherwise(fits)
    return F.coalesce(fits, F.lit(True))


def is_compatible(left_type: str, right_type: str) -> bool:
    """The same for two names on the driver."""
    targets = COMPATIBLE.get(left_type)
    return targets is None or right_type.upper().startswith(tuple(targets))


def cast_type(logical: Column) -> Column:
    """Staging cast type of a logical type."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(CAST_TYPES.items())])
    return F.coalesce(F.try_element_at(lookup, F.upper(logical)), F.lit(CAST_FALLBACK))


def logical_type(dt: T.DataType) -> str:
    """Logical type of a Spark column."""
    if isinstance(dt, T.IntegralType):
        return "LONG"
    if isinstance(dt, T.NumericType):
        return "DOUBLE"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    return "STRING"


def load_type(dt: T.DataType) -> str:
    """Column type a load declares for a Spark column."""
    return {"LONG": "INTEGER", "DOUBLE": "FLOAT", "DATETIME": "TIMESTAMP", "BOOLEAN": "BOOLEAN"}.get(
        logical_type(dt), "VARCHAR(16777216)"
    )


def declared_type(name: str) -> str:
    """Spark type of a declared type name; ``DECIMAL(p,s)`` and ``NUMBER(p,s)`` stay exact."""
    upper = name.strip().upper()
    for prefix in ("DECIMAL(", "NUMBER("):
        if upper.startswith(prefix):
            return "decimal(" + upper[len(prefix):].lower()
    return next((spark for spark, names in DECLARED_TYPES.items() if upper in names), "string")
