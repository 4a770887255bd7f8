"""Name-normalisation rules as Column expressions.

Each rule maps one string column, so a whole catalog of names is normalised in a
single scan. ``rename_columns`` applies the same rule to a DataFrame's own header.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# The reserved words a target column name is checked against.
RESERVED_WORDS = [
    "date", "dates", "time", "timestamp", "year", "month", "day",
    "hour", "minute", "second", "order", "group", "select", "from",
    "where", "and", "or", "not", "null", "true", "false", "case",
    "when", "then", "else", "end", "as", "in", "like", "between",
    "is", "exists", "all", "any", "some", "distinct", "count",
    "sum", "avg", "min", "max", "first", "last", "limit", "offset",
]


def strip(c: Column) -> Column:
    """Trim every kind of ASCII whitespace from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def _squeeze(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, "_+", "_"), F.lit("_"))


def transform_name(c: Column) -> Column:
    """Upper-case identifier; ``no.``/``#``/``&`` become words, punctuation ``_``."""
    worded = F.regexp_replace(F.lower(c), r"\bno\.\s*", "number_")
    worded = F.replace(F.replace(worded, F.lit("#"), F.lit("number")), F.lit("&"), F.lit("and"))
    return F.upper(_squeeze(F.translate(worded, "() -/.?", "_" * 7)))


def warehouse_name(c: Column) -> Column:
    """Upper-case identifier with only ASCII letters, digits and ``_``; never empty."""
    worded = F.replace(c, F.lit("#"), F.lit("number"))
    squeezed = _squeeze(F.lower(F.regexp_replace(worded, "[^a-zA-Z0-9_]", "_")))
    return F.upper(F.when(squeezed == "", F.lit("unnamed_column")).otherwise(squeezed))


def is_reserved(c: Column) -> Column:
    """Whether a name is a reserved word, in any case."""
    return F.lower(c).isin(RESERVED_WORDS)


def table_name(dataset_id: Column, name: Column) -> Column:
    """Target table name from the dataset's name, or from its id when it has none."""
    has_name = name.isNotNull() & (strip(name) != "") & (F.lower(name) != "unknown")
    from_name = F.regexp_replace(F.translate(strip(F.lower(name)), " -.", "___"), "[^a-z0-9_]", "")
    from_name = F.when(from_name.rlike("^[0-9]"), F.concat(F.lit("tbl_"), from_name)).otherwise(from_name)
    from_id = F.regexp_replace(F.translate(dataset_id, "-.", "__"), "[^a-zA-Z0-9_]", "")
    from_id = F.when(from_id.rlike("^[0-9]"), F.concat(F.lit("id_"), from_id)).otherwise(from_id)
    return F.rtrim(F.substring(F.when(has_name, from_name).otherwise(from_id), 1, 240), F.lit("_"))


def identifier(c: Column) -> Column:
    """Upper-case identifier of at most 255 characters, ``UNNAMED`` when empty."""
    squeezed = _squeeze(F.regexp_replace(F.upper(c), "[^A-Z0-9_]", "_"))
    return F.substring(F.when(squeezed == "", F.lit("UNNAMED")).otherwise(squeezed), 1, 255)


def stage_alias(c: Column) -> Column:
    """Lower-case alias used by staging projections."""
    return F.lower(F.regexp_replace(F.translate(c, " ", "_"), "[^0-9A-Za-z_]", ""))


def match_key(c: Column) -> Column:
    """Fuzzy matching key: lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def source_identifier(c: Column) -> Column:
    """Upper-case identifier used by the source manifest."""
    return F.upper(F.translate(F.regexp_replace(c, "[^0-9a-zA-Z_ ]", ""), " ", "_"))


def apply_to_header(spark, header: list[str], rule: Callable[[Column], Column]) -> list[str]:
    """Evaluate a name rule over a DataFrame header (metadata, a handful of strings)."""
    row = spark.range(1).select(*[rule(F.lit(h)).alias(f"c{i}") for i, h in enumerate(header)]).first()
    return list(row)


def rename_columns(df: DataFrame, rule: Callable[[Column], Column] = transform_name) -> DataFrame:
    """Rename a DataFrame's columns by ``rule``, suffixing repeats; all names differ afterwards.

    With ``transform_name`` the k-th repeat of a name takes the k-th suffix that makes no name of the header; with the other rules
    it takes the first suffix that no column before it has.
    """
    ruled = apply_to_header(df.sparkSession, df.columns, rule)
    taken, names = set(ruled) if rule is transform_name else set(), []
    for name in ruled:
        candidate, suffix = name, 0
        while candidate in names or (suffix and candidate in taken):
            suffix += 1
            candidate = f"{name}_{suffix}"
        names.append(candidate)
    return df.toDF(*names)
