"""Keyed comparison of two tables: matching, differences, duplicates.

Keys match null-safely (NULL equals NULL). Rows that share a key are paired by their
occurrence number, so a key held by many rows never multiplies. Rows of keys too frequent
for one task are split off and spread before they are numbered or joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols, partner_keys, same_key
from ferrytally.operators.numbering import (
    BROADCAST_KEYS, HOT_ROWS, KeyProfile, first_rows, hot_keys, number_hot, number_within, profile_keys, sortable, split_hot,
)

OCCURRENCE = "occurrence"
SIDE = "side"


def _floats(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere in a comparison."""
    floats = _floats(df)
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats}) if floats else df


def align_case(df: DataFrame, like: list[str]) -> DataFrame:
    """Rename columns to the spelling in ``like`` where they differ only in case."""
    spelling = {c.lower(): c for c in like}
    return df.toDF(*[spelling.get(c.lower(), c) for c in df.columns])


def string_keys(left: DataFrame, right: DataFrame, keys: list[str], always: bool = False):
    """Cast a key to string on both sides where its types differ (or always)."""
    for k in keys:
        if always or left.schema[k].dataType != right.schema[k].dataType:
            left = left.withColumn(k, col(k).cast("string"))
            right = right.withColumn(k, col(k).cast("string"))
    return left, right


@dataclass(frozen=True)
class Pair:
    """Two frames made comparable."""

    left: DataFrame
    right: DataFrame
    keys: list[str]
    common: list[str]
    left_extra: list[str]
    right_extra: list[str]


def prepare(left: DataFrame, right: DataFrame, keys: list[str], keys_as_text: bool = False) -> Pair:
    """Align column spelling, treat NaN as NULL, harmonise key types."""
    left = align_case(left, keys)
    right = align_case(right, left.columns)
    left, right = string_keys(nan_as_null(left), nan_as_null(right), keys, keys_as_text)
    common = [c for c in left.columns if c in right.columns and c not in keys]
    return Pair(
        left, right, keys, common,
        [c for c in left.columns if c not in right.columns],
        [c for c in right.columns if c not in left.columns],
    )


def occurrence_number(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """n-th occurrence of each key, rows of a key ordered by all other columns."""
    others = [c for c in df.columns if c not in keys]
    return number_within(df, keys, others, OCCURRENCE, hot_rows)


def _joined(pair: Pair, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer match: keys, occurrence, side, and common column ``i`` as ``l_<i>`` and ``r_<i>``.

    The plan follows the measured keys. Unique keys are joined directly. Repeated keys are paired
    after a single exchange of both sides. Rows of keys too frequent for one task are numbered
    apart, spread over many tasks, and then paired on ``(keys, occurrence)``.
    """
    keys = pair.keys
    left = pair.left.select(*cols(keys), *cols(pair.common))
    right = pair.right.select(*cols(keys), *cols(pair.common))
    profile = profile_keys([left, right], keys, hot_rows)
    if profile.largest <= 1:
        return _join_unique(left, right, pair, profile)
    same = [left.schema[c].dataType == right.schema[c].dataType for c in pair.common]
    both = _stacked(left, True, pair, same).union(_stacked(right, False, pair, same))
    if profile.hot_keys == 0:
        return _paired(_numbered_in_place(both, pair, same), pair, same)
    hot = hot_keys([left, right], keys, hot_rows)
    cold_part, hot_part = split_hot(both, hot, keys, profile.hot_keys)
    spread = number_hot(
        hot_part, [*keys, "is_left"], _stacked_order(pair, same), OCCURRENCE, hot_rows, profile.hot_rows
    )
    return _paired(_numbered_in_place(cold_part, pair, same), pair, same).unionByName(_paired(spread, pair, same))


def _join_unique(left: DataFrame, right: DataFrame, pair: Pair, profile: KeyProfile) -> DataFrame:
    """Full outer join on keys that are unique on both sides."""
    keys = pair.keys
    left = left.select(
        *[col(k).alias(f"lk_{i}") for i, k in enumerate(keys)],
        *[col(c).alias(f"l_{i}") for i, c in enumerate(pair.common)], F.lit(True).alias("in_left"),
    )
    right = right.select(
        *[col(k).alias(f"rk_{i}") for i, k in enumerate(keys)],
        *[col(c).alias(f"r_{i}") for i, c in enumerate(pair.common)], F.lit(True).alias("in_right"),
    )
    sides = [(F.col(f"lk_{i}"), F.col(f"rk_{i}")) for i in range(len(keys))]
    on = [a.eqNullSafe(b) if profile.has_null else a == b for a, b in sides]
    joined = left.join(right, reduce(lambda a, b: a & b, on), "full")
    key_of = [F.when(F.col("in_left"), a).otherwise(b).alias(k) for k, (a, b) in zip(keys, sides, strict=True)]
    return _tagged(joined, key_of, F.lit(1).cast("bigint"), len(pair.common))


def _stacked(df: DataFrame, is_left: bool, pair: Pair, same: list[bool]) -> DataFrame:
    """One side in the layout both share: a column of one type once, of two types once per type."""
    out = cols(pair.keys)
    for i, c in enumerate(pair.common):
        if same[i]:
            out.append(col(c).alias(f"v_{i}"))
            continue
        lt, rt = pair.left.schema[c].dataType, pair.right.schema[c].dataType
        out.append((col(c) if is_left else F.lit(None).cast(lt)).alias(f"l_{i}"))
        out.append((F.lit(None).cast(rt) if is_left else col(c)).alias(f"r_{i}"))
    return df.select(*out, F.lit(is_left).alias("is_left"))


def _stacked_order(pair: Pair, same: list[bool]) -> list[str]:
    return [n for i in range(len(pair.common)) for n in ([f"v_{i}"] if same[i] else [f"l_{i}", f"r_{i}"])]


def _numbered_in_place(both: DataFrame, pair: Pair, same: list[bool]) -> DataFrame:
    """Occurrence numbers per side after one exchange by key; no key is hot here."""
    order = [sortable(both, c).asc_nulls_first() for c in _stacked_order(pair, same)] or [F.lit(1).asc()]
    window = Window.partitionBy(*cols(pair.keys), "is_left").orderBy(*order)
    return both.repartition(*cols(pair.keys)).withColumn(OCCURRENCE, F.row_number().over(window).cast("bigint"))


def _paired(numbered: DataFrame, pair: Pair, same: list[bool]) -> DataFrame:
    """Fold the (at most two) rows with the same key and occurrence into one.

    Needs no further exchange where the rows are partitioned by key already.
    """
    is_left = F.col("is_left")
    folded = [F.max(F.when(is_left, True)).alias("in_left"), F.max(F.when(~is_left, True)).alias("in_right")]
    for i in range(len(pair.common)):
        for side, here in (("l", is_left), ("r", ~is_left)):
            value = F.when(here, F.col(f"v_{i}")) if same[i] else F.col(f"{side}_{i}")
            # One row of a side at most, so any value is its value; maps have no maximum.
            is_map = isinstance(numbered.schema[f"v_{i}" if same[i] else f"{side}_{i}"].dataType, T.MapType)
            folded.append((F.first(value, ignorenulls=True) if is_map else F.max(value)).alias(f"{side}_{i}"))
    rows = numbered.groupBy(*cols(pair.keys), OCCURRENCE).agg(*folded)
    return _tagged(rows, cols(pair.keys), F.col(OCCURRENCE), len(pair.common))


def _tagged(df: DataFrame, keys: list[Column], occurrence: Column, common: int) -> DataFrame:
    side = (
        F.when(F.col("in_left").isNull(), "right_only")
        .when(F.col("in_right").isNull(), "left_only")
        .otherwise("both")
    )
    values = [f"{s}_{i}" for i in range(common) for s in "lr"]
    return df.select(*keys, occurrence.alias(OCCURRENCE), side.alias(SIDE), *values)


def compare_join(
    left: DataFrame, right: DataFrame, keys: list[str], keys_as_text: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Full outer match tagged ``both``/``left_only``/``right_only``.

    Common columns come back as ``<name>_left`` and ``<name>_right``.
    """
    pair = prepare(left, right, keys, keys_as_text)
    joined = _joined(pair, hot_rows)
    values = []
    for i, c in enumerate(pair.common):
        values += [F.col(f"l_{i}").alias(f"{c}_left"), F.col(f"r_{i}").alias(f"{c}_right")]
    return joined.select(*cols(keys), OCCURRENCE, SIDE, *values)


def left_only(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of the left side without a partner on the right.

    Only the number of rows per key matters on the right, so the right side is reduced to
    counts before it is shuffled to the join. Rows of hot keys stay where they were numbered: the
    counts of those few keys are sent to them.
    """
    pair = prepare(left, right, keys)
    ordered = pair.left.select(*cols(keys), *cols(pair.common), *cols(pair.left_extra))
    counts = pair.right.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("__partners"))
    columns = cols(pair.left.columns)
    profile = profile_keys([ordered], keys, hot_rows)
    if profile.hot_keys == 0:
        return _beyond(occurrence_number(ordered, keys, hot_rows), counts, keys).select(*columns)
    hot = hot_keys([ordered], keys, hot_rows)
    cold_part, hot_part = split_hot(ordered, hot, keys, profile.hot_keys)
    others = [c for c in ordered.columns if c not in keys]
    spread = number_hot(hot_part, keys, others, OCCURRENCE, hot_rows, profile.hot_rows)
    few = counts.join(hot.select(*[f"__k{i}" for i in range(len(keys))]), same_key(keys), "left_semi")
    kept = _beyond(spread, few, keys, profile.hot_keys <= BROADCAST_KEYS)
    return _beyond(occurrence_number(cold_part, keys, hot_rows), counts, keys).select(*columns).unionByName(kept.select(*columns))


def _beyond(numbered: DataFrame, counts: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Numbered rows past the number of partners their key has."""
    side = partner_keys(counts, keys)
    joined = numbered.join(F.broadcast(side) if small else side, same_key(keys), "left")
    return joined.filter(F.col(OCCURRENCE) > F.coalesce(F.col("__partners"), F.lit(0)))


def right_only(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    return left_only(right, left, keys, hot_rows)


def rows_common(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Matched rows, left and right values side by side."""
    return compare_join(left, right, keys, hot_rows=hot_rows).filter(F.col(SIDE) == "both").drop(SIDE)


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _exact(dt: T.DataType) -> bool:
    return isinstance(dt, T.IntegralType)


@dataclass(frozen=True)
class _Column:
    name: str
    equal: Column
    diff: Column
    one_null: Column


def _columns(pair: Pair, abs_tol: float, rel_tol: float) -> list[_Column]:
    out = []
    for i, c in enumerate(pair.common):
        a, b = F.col(f"l_{i}"), F.col(f"r_{i}")
        lt, rt = pair.left.schema[c].dataType, pair.right.schema[c].dataType
        diff = F.lit(None).cast("double")
        if _numeric(lt) and _numeric(rt):
            # Doubles cannot tell large integers apart.
            kind = "decimal(20,0)" if _exact(lt) and _exact(rt) else "double"
            diff = F.abs(a.cast(kind) - b.cast(kind)).cast("double")
            equal = a.eqNullSafe(b)
            if abs_tol or rel_tol:
                close = diff <= F.lit(abs_tol) + F.lit(rel_tol) * F.abs(b.cast("double"))
                equal = F.coalesce(equal | close, F.lit(False))
        elif isinstance(lt, T.MapType) and lt == rt:
            equal = F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))
        elif lt == rt:
            equal = a.eqNullSafe(b)
        elif isinstance(lt, _TIMES) and isinstance(rt, _TIMES):
            equal = a.cast("timestamp_ntz").eqNullSafe(b.cast("timestamp_ntz"))
        else:
            equal = a.cast("string").eqNullSafe(b.cast("string"))
        out.append(_Column(c, equal, diff, a.isNull() != b.isNull()))
    return out


COLUMN_STATS = (
    "array<struct<column:string,match_cnt:bigint,unequal_cnt:bigint,all_match:boolean,max_diff:double,null_diff:bigint>>"
)


def compare_totals(
    pair: Pair, abs_tol: float = 0.0, rel_tol: float = 0.0, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Everything countable about a comparison, in one aggregate over one join.

    One row: row totals, duplicate rows and ``columns``, an array with one struct of
    statistics per common column.
    """
    both = F.col(SIDE) == "both"
    in_left, in_right = F.col(SIDE) != "right_only", F.col(SIDE) != "left_only"
    occ = F.col(OCCURRENCE)
    columns = _columns(pair, abs_tol, rel_tol)
    any_unequal = reduce(lambda a, b: a | b, [~c.equal for c in columns], F.lit(False))

    def repeated(side: Column) -> Column:
        # A key with n > 1 rows contributes occurrences 2..n, plus its first row.
        return F.count_if(side & (occ >= 2)) + F.count_if(side & (occ == 2))

    aggregates = [
        F.count_if(both).alias("common_rows"),
        F.count_if(F.col(SIDE) == "left_only").alias("left_only_rows"),
        F.count_if(F.col(SIDE) == "right_only").alias("right_only_rows"),
        F.count_if(both & any_unequal).alias("rows_with_differences"),
        repeated(in_left).alias("left_duplicate_rows"),
        repeated(in_right).alias("right_duplicate_rows"),
    ]
    for i, c in enumerate(columns):
        aggregates += [
            F.count_if(both & c.equal).alias(f"eq_{i}"),
            F.max(F.when(both, c.diff)).alias(f"diff_{i}"),
            F.count_if(both & c.one_null).alias(f"null_{i}"),
        ]
    totals = _joined(pair, hot_rows).agg(*aggregates)
    stats = [
        F.struct(
            F.lit(c.name).alias("column"),
            F.col(f"eq_{i}").alias("match_cnt"),
            (F.col("common_rows") - F.col(f"eq_{i}")).alias("unequal_cnt"),
            (F.col("common_rows") == F.col(f"eq_{i}")).alias("all_match"),
            F.coalesce(F.col(f"diff_{i}"), F.lit(0.0)).alias("max_diff"),
            F.col(f"null_{i}").alias("null_diff"),
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(
        "common_rows", "left_only_rows", "right_only_rows", "rows_with_differences",
        "left_duplicate_rows", "right_duplicate_rows",
        (F.array(*stats) if stats else F.array()).cast(COLUMN_STATS).alias("columns"),
    )


def column_stats(
    left: DataFrame, right: DataFrame, keys: list[str], abs_tol: float = 0.0, rel_tol: float = 0.0,
    keys_as_text: bool = False, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per common column over matched rows: equal, unequal, largest difference, one-sided NULLs."""
    pair = prepare(left, right, keys, keys_as_text)
    return compare_totals(pair, abs_tol, rel_tol, hot_rows).select(F.inline("columns"))


def columns_with_differences(stats: DataFrame, mode: str = "strict") -> DataFrame:
    """Columns that differ; ``reference`` mode also asks for a numeric or NULL difference."""
    differs = F.col("unequal_cnt") > 0
    if mode == "reference":
        differs = differs & ((F.col("max_diff") > 0) | (F.col("null_diff") > 0))
    return stats.filter(differs)


def rows_with_differences(
    left: DataFrame, right: DataFrame, keys: list[str], abs_tol: float = 0.0, rel_tol: float = 0.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Matched rows in which at least one common column differs, with the column names."""
    pair = prepare(left, right, keys)
    named = [F.when(~c.equal, F.lit(c.name)) for c in _columns(pair, abs_tol, rel_tol)]
    differing = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return (
        _joined(pair, hot_rows).filter(F.col(SIDE) == "both")
        .select(*cols(keys), OCCURRENCE, differing.alias("columns")).filter(F.size("columns") > 0)
    )


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = nan_as_null(df).groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > 1)


def duplicate_row_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is repeated, and how many keys those are."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_rows"), F.count(F.lit(1)).alias("duplicate_keys")
    )


def duplicate_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Repeated keys with counts; ``limit`` asks for a listing of the first ones in key order."""
    counts = key_counts(df, keys)
    if limit is None:
        return counts
    return first_rows(counts, cols(keys), limit, nulls_last=True)


def distinct_keys(df: DataFrame, keys: list[str], drop_null: bool = False) -> DataFrame:
    chosen = df.select(*cols(keys))
    return (chosen.na.drop("any") if drop_null else chosen).distinct()


def top_examples(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """The first ``k`` rows in key order, for a report listing."""
    return first_rows(df, cols(keys), k, nulls_last=True)
