"""Cell-level cleaning: blanks, masks, id lists, scientific notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrytally.functions.names import strip

LIST_SEPARATOR = ",\n"

# Text forms of a truthy flag.
TRUTHY = ["true", "1", "yes", "y"]
ENABLED = [*TRUTHY, "enabled"]

# Fixed value: text that counts as scientific notation.
SCIENTIFIC = r"^-?\d+\.\d+e[+-]\d+$"


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(r"^\s*$"), c)


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (strip(c.cast("string")) != "")


def flag(c: Column, truthy: list[str] = TRUTHY) -> Column:
    """Truthy text as a boolean; NULL counts as false."""
    return F.coalesce(F.lower(c.cast("string")).isin(truthy), F.lit(False))


def mask_prefix(c: Column, visible: int = 2) -> Column:
    """First ``visible`` characters, the rest starred; ``***`` for short or empty text."""
    hidden = F.concat(F.substring(c, 1, visible), F.repeat(F.lit("*"), F.length(c) - visible))
    return F.when(F.length(c) > visible, hidden).otherwise(F.lit("***"))


def mask_middle(c: Column) -> Column:
    """First and last three characters, the middle starred; ``***`` up to length six."""
    hidden = F.concat(F.substring(c, 1, 3), F.repeat(F.lit("*"), F.length(c) - 6), F.right(c, F.lit(3)))
    return F.when(F.length(c) > 6, hidden).otherwise(F.lit("***"))


def split_ids(c: Column) -> Column:
    """Ids of a comma/newline separated cell, trimmed, blanks dropped; ``[]`` for NULL."""
    parts = F.transform(F.split(F.coalesce(c.cast("string"), F.lit("")), r"[\n,]+"), strip)
    return F.filter(parts, lambda x: x != "")


def clean_ids(c: Column) -> Column:
    """Distinct sorted ids of a cell, as a cell."""
    return F.array_join(F.array_sort(F.array_distinct(split_ids(c))), LIST_SEPARATOR)


def fix_scientific(c: Column) -> Column:
    """Rewrite scientific-notation text as plain integer text, leave other text alone.

    Goes through bigint, which is exact for every double below 2^63; larger magnitudes go
    through decimal.
    """
    rounded = F.rint(c.try_cast("double"))
    whole = F.coalesce(rounded.try_cast("bigint").cast("string"), rounded.try_cast("decimal(38,0)").cast("string"))
    return F.when(c.rlike(SCIENTIFIC), F.coalesce(whole, c)).otherwise(c)


def key_text(keys: list[str]) -> Column:
    """``(k1=v1, k2=v2)`` text of a key."""
    pairs = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("None"))) for k in keys]
    return F.concat(F.lit("("), F.concat_ws(", ", *pairs), F.lit(")"))
