"""Type inference, schema enforcement and cleaning of whole tables.

Inference looks at every row: one aggregate profiles all text columns at once and a single
projection then converts them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols
from ferrytally.functions import cells
from ferrytally.functions.types import (
    FALSE_TEXT, NUMERIC_KEYWORDS, TRUE_TEXT, as_boolean, as_double, as_long, as_timestamp, cast_type,
    declared_type, logical_type,
)
from ferrytally.operators.numbering import first_rows

THRESHOLD = 0.8
STEPS = ("numeric", "datetime", "boolean")
_CONVERT = {"numeric": as_double, "datetime": as_timestamp, "boolean": as_boolean}


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.na.drop("all")


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


@dataclass(frozen=True)
class TextProfile:
    """What the non-NULL values of a text column look like."""

    values: int
    numbers: int
    datetimes: int
    other_than_boolean: int
    boolean_spellings: int

    def decide(self, steps: tuple[str, ...], threshold: float) -> str | None:
        """First step that fits; later steps only see columns earlier ones left as text."""
        if self.values:
            if "numeric" in steps and self.numbers / self.values >= threshold:
                return "numeric"
            if "datetime" in steps and self.datetimes / self.values >= threshold:
                return "datetime"
        if "boolean" in steps and self.values and not self.other_than_boolean and self.boolean_spellings <= 2:
            return "boolean"
        return None


def profile_text(df: DataFrame) -> dict[str, TextProfile]:
    """Profile all text columns in one pass."""
    names = text_columns(df)
    if not names:
        return {}
    aggregates = []
    for i, name in enumerate(names):
        c = col(name)
        boolean = F.lower(c).isin(TRUE_TEXT + FALSE_TEXT)
        aggregates += [
            F.count(c).alias(f"values_{i}"),
            F.count_if(as_double(c).isNotNull()).alias(f"numbers_{i}"),
            F.count_if(as_timestamp(c).isNotNull()).alias(f"datetimes_{i}"),
            F.count_if(c.isNotNull() & ~boolean).alias(f"other_{i}"),
            # Spellings of six short words: the set cannot grow with the data.
            F.size(F.collect_set(F.when(boolean, c))).alias(f"spellings_{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        name: TextProfile(*[row[f"{p}_{i}"] for p in ("values", "numbers", "datetimes", "other", "spellings")])
        for i, name in enumerate(names)
    }


def conversions(
    df: DataFrame, steps: tuple[str, ...] = STEPS, threshold: float = THRESHOLD
) -> dict[str, Column]:
    """Columns to convert and the expression that does it."""
    decided = {name: p.decide(steps, threshold) for name, p in profile_text(df).items()}
    return {name: _CONVERT[step](col(name)) for name, step in decided.items() if step}


def convert(df: DataFrame, converted: dict[str, Column]) -> DataFrame:
    return df.select(*[converted.get(c, col(c)).alias(c) for c in df.columns])


def infer_numeric(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Text columns in which enough values are numbers become double."""
    return convert(df, conversions(df, ("numeric",), threshold))


def infer_datetime(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Text columns in which enough values are dates become timestamps."""
    return convert(df, conversions(df, ("datetime",), threshold))


def infer_boolean(df: DataFrame) -> DataFrame:
    """Text columns holding at most two spellings of yes/no become boolean."""
    return convert(df, conversions(df, ("boolean",)))


def auto_types(df: DataFrame) -> DataFrame:
    """Drop empty rows, trim headers, then infer number, date and boolean columns."""
    cleaned = trim_headers(drop_empty_rows(df))
    return convert(cleaned, conversions(cleaned))


def null_counts_introduced(df: DataFrame, converted: dict[str, Column]) -> DataFrame:
    """Per converted column, how many values a conversion turns into NULL."""
    names = list(converted)
    lost = [F.count_if(col(n).isNotNull() & converted[n].isNull()).alias(f"lost_{i}") for i, n in enumerate(names)]
    if not lost:
        return df.sparkSession.createDataFrame([], "column string, introduced_nulls bigint")
    entries = [
        F.struct(F.lit(n).alias("column"), F.col(f"lost_{i}").alias("introduced_nulls")) for i, n in enumerate(names)
    ]
    return df.agg(*lost).select(F.inline(F.array(*entries)))


def _share(parsed: Column, value: Column, threshold: float) -> Column:
    """Whether enough of the values that are not blank can be parsed."""
    filled = value.isNotNull() & (F.trim(value) != "")
    return (F.count_if(filled) > 0) & (F.count_if(filled & parsed.isNotNull()) >= threshold * F.count_if(filled))


def logical_types(
    df: DataFrame, n: int | None = None, order: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``(ordinal, name, logical_type, warehouse_type)`` of each column.

    Typed columns keep their type. A text column is DATETIME when at least ``threshold`` of its values are
    dates, DOUBLE when as many are numbers and the column's name suggests a quantity, else STRING. ``n``
    restricts the evidence to the first ``n`` rows in ``order``.
    """
    sample = df if n is None else first_rows(df, cols(order or df.columns), n)
    names = text_columns(df)
    evidence = [F.lit(0).alias("none")]
    for i, name in enumerate(names):
        evidence += [
            _share(as_timestamp(col(name)), col(name), threshold).alias(f"date_{i}"),
            _share(as_double(col(name)), col(name), threshold).alias(f"number_{i}"),
        ]
    entries = []
    for ordinal, f in enumerate(df.schema, 1):
        logical = F.lit(logical_type(f.dataType))
        if f.name in names:
            i = names.index(f.name)
            quantity = any(k in f.name.lower() for k in NUMERIC_KEYWORDS)
            logical = (
                F.when(F.col(f"date_{i}"), "DATETIME")
                .when(F.col(f"number_{i}") & F.lit(quantity), "DOUBLE")
                .otherwise("STRING")
            )
        entries.append(
            F.struct(
                F.lit(ordinal).alias("ordinal"), F.lit(f.name).alias("name"), logical.alias("logical_type"),
                cast_type(logical).alias("warehouse_type"),
            )
        )
    return sample.agg(*evidence).select(F.inline(F.array(*entries)))


def parse_schema(declared: str) -> dict[str, str]:
    """``"ID:TEXT,AMOUNT:DECIMAL(10,2)"`` as column -> Spark type; parts without ``:`` are ignored."""
    parts, depth, current = [], 0, ""
    for ch in declared:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    named = [p.split(":", 1) for p in [*parts, current] if ":" in p]
    return {name.strip(): declared_type(kind) for name, kind in named}


def _clean_text(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return cells.fix_scientific(F.when(text.isin("nan", "NaN"), F.lit("")).otherwise(text))


def apply_schema(df: DataFrame, declared: str | T.StructType, keys: list[str] | None = None) -> DataFrame:
    """Cast declared columns; values that do not fit become NULL.

    Declared text and undeclared keys become text without NULLs, ``nan`` or scientific
    notation. Declared columns the table lacks are skipped.
    """
    if isinstance(declared, T.StructType):
        wanted = {f.name: f.dataType.simpleString() for f in declared}
    else:
        wanted = parse_schema(declared)
    if not wanted:
        return df
    wanted.update({k: "string" for k in keys or [] if k not in wanted})
    texts = text_columns(df)
    parsers = {"bigint": as_long, "double": as_double, "timestamp_ntz": as_timestamp, "boolean": as_boolean}
    out = []
    for name in df.columns:
        kind = wanted.get(name)
        if kind is None:
            out.append(col(name))
        elif kind == "string":
            out.append(_clean_text(col(name)).alias(name))
        elif name in texts and kind in parsers:
            out.append(parsers[kind](col(name)).alias(name))
        else:
            out.append(col(name).try_cast(kind).alias(name))
    return df.select(*out)


def failing_columns(df: DataFrame, target: T.StructType) -> list[str]:
    """Columns with at least one value that the target type cannot hold (one aggregate)."""
    checked = [f for f in target if f.name in df.columns]
    if not checked:
        return []
    failures = [
        F.bool_or(col(f.name).isNotNull() & col(f.name).try_cast(f.dataType).isNull()).alias(f"bad_{i}")
        for i, f in enumerate(checked)
    ]
    row = df.agg(*failures).first()
    return [f.name for i, f in enumerate(checked) if row[f"bad_{i}"]]


def coerce_failing_to_string(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast to the target types, but keep columns that do not fit as text."""
    failing = failing_columns(df, target)
    types = {f.name: f.dataType for f in target}
    out = []
    for name in df.columns:
        if name in failing:
            out.append(col(name).cast("string").alias(name))
        elif name in types:
            out.append(col(name).cast(types[name]).alias(name))
        else:
            out.append(col(name))
    return df.select(*out)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty and whitespace-only text becomes NULL."""
    texts = text_columns(df)
    return df.select(*[cells.blank_to_null(col(c)).alias(c) if c in texts else col(c) for c in df.columns])


def mask_columns(df: DataFrame, names: list[str], mode: str = "prefix", visible: int = 2) -> DataFrame:
    """Mask columns: keep a prefix, or keep three characters at each end (``middle``)."""
    def mask(c: Column) -> Column:
        return cells.mask_middle(c) if mode == "middle" else cells.mask_prefix(c, visible)

    return df.select(*[mask(col(c).cast("string")).alias(c) if c in names else col(c) for c in df.columns])
