"""Schema operators over column tables ``(dataset, ordinal, name, type)``.

A column table holds the columns of many datasets, so one job compares a whole catalog.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols, partner_keys, same_key
from ferrytally.functions.names import match_key, transform_name
from ferrytally.functions.types import cast_type, load_type, logical_type, types_compatible
from ferrytally.operators.numbering import BROADCAST_KEYS, HOT_ROWS, number_within
from ferrytally.session import materialise

COLUMN_TABLE = "dataset string, ordinal int, name string, type string"


def column_table(spark: SparkSession, tables: dict[str, DataFrame], type_of=logical_type) -> DataFrame:
    """Column table of DataFrames, from their schemas alone."""
    rows = [
        (dataset, i, f.name, type_of(f.dataType))
        for dataset, df in tables.items()
        for i, f in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(rows, COLUMN_TABLE)


def load_schema(df: DataFrame) -> DataFrame:
    """Column name and the type a load declares for it."""
    rows = [(i, f.name, load_type(f.dataType)) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, ddl_type string")


_STEM, _NUMBER = "__stem", "__number"
# A suffix that a repeat could get: no leading zero, and small enough to count up to.
_SUFFIXED = "(?s)^(.*)_([1-9][0-9]{0,17})$"


def unique_names(names: DataFrame, name: Column, by: list[str], ordinal: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``final_name``: the k-th repeat (k >= 1) of a name gets ``_`` and the k-th number that makes no name of its scope.

    Without names that look like suffixed repeats that is ``_k``; ``A, A, A_1`` becomes ``A, A_2, A_1``. The first row of a name
    keeps it, so all final names of a scope differ. A null name stays null.
    """
    named = names.withColumn("__name", name)
    numbered = number_within(named, [*by, "__name"], [ordinal], "__k", hot_rows)
    # Names that could be mistaken for a repeat, if their stem has any: (scope, stem, number), once each.
    repeated = numbered.filter("__k = 2").select(*cols(by), F.col("__name").alias(_STEM))
    taken = numbered.filter("__k = 1").select(
        *cols(by), F.regexp_extract("__name", _SUFFIXED, 1).alias(_STEM), F.regexp_extract("__name", _SUFFIXED, 2).alias(_NUMBER),
    ).filter(F.col(_NUMBER) != "").withColumn(_NUMBER, F.col(_NUMBER).cast("bigint"))
    stem = [*by, _STEM]
    taken = materialise(taken.join(partner_keys(repeated, stem), same_key(stem), "left_semi"))
    count = taken.count()
    if count == 0:
        return _suffixed(numbered, F.col("__k") - 1)
    # A taken number r, the j-th of its stem, has r - j free numbers before it: it moves every repeat beyond those by one. So repeats and
    # taken numbers are numbered together, each taken one right before the first repeat it moves, and that number is the suffix.
    places = number_within(taken, stem, [_NUMBER], "__j", hot_rows).select(
        *cols(stem), (F.col(_NUMBER) - F.col("__j")).alias("__at"), F.lit(0).alias("__kind"), col(_NUMBER)
    )
    stems = taken.select(*cols(stem)).distinct().withColumnRenamed(_STEM, "__name")
    contested = partner_keys(stems, [*by, "__name"])
    if count <= BROADCAST_KEYS:
        contested = F.broadcast(contested)
    repeats = numbered.filter("__k > 1")
    moved = repeats.join(contested, same_key([*by, "__name"]), "left_semi").select(
        *cols(numbered.columns), F.col("__name").alias(_STEM), (F.col("__k") - 2).alias("__at"), F.lit(1).alias("__kind"),
    )
    # The columns stay side by side: Spark cannot plan fields of a struct that are taken above the explosions of hot keys.
    ranked = number_within(
        moved.unionByName(places.drop(_NUMBER), allowMissingColumns=True), stem, ["__at", "__kind"], "__suffix", hot_rows
    ).filter("__kind = 1").select(*cols(numbered.columns), "__suffix")
    others = numbered.filter("__k = 1").unionByName(repeats.join(contested, same_key([*by, "__name"]), "left_anti"))
    return _suffixed(others, F.col("__k") - 1).unionByName(_suffixed(ranked, F.col("__suffix")).drop("__suffix"))


def _suffixed(numbered: DataFrame, suffix: Column) -> DataFrame:
    final = F.when(F.col("__k") == 1, F.col("__name")).otherwise(F.concat("__name", F.lit("_"), suffix.cast("string")))
    return numbered.withColumn("final_name", final).drop("__name", "__k")


def unique_in_header(names: DataFrame, name: Column, by: list[str], ordinal: str) -> DataFrame:
    """Add ``final_name``: a repeat takes the first suffix ``_1``, ``_2`` ... that no name before it in its header has.

    All final names differ. A name and its suffixed forms are alike up to the digits and ``_`` at their end, so the names of a header
    that are alike up to there are gone through in order, by themselves and once: no number is tried again for a name. A null name stays
    null, and so does every repeat after it in its header.
    """
    columns = names.columns
    named = names.withColumn("__name", name)
    nulls = materialise(named.filter(F.col("__name").isNull()).groupBy(*cols(by)).agg(
        F.bool_or(col(ordinal).isNull()).alias("__any"), F.min(col(ordinal)).alias("__first")
    ))
    late, count = F.lit(False), nulls.count()
    if count:
        # Null names come first among those of one ordinal, null ordinals before all others.
        side = partner_keys(nulls, by)
        named = named.join(F.broadcast(side) if count <= BROADCAST_KEYS else side, same_key(by) if by else F.lit(True), "left")
        late = F.coalesce(F.col("__any") | (F.col("__first") <= col(ordinal)), F.lit(False))
    stem = F.rtrim(F.col("__name"), F.lit("_0123456789"))
    order = [col(ordinal), F.col("__name"), *cols(columns)]
    place = F.row_number().over(Window.partitionBy(*cols(by), "__stem").orderBy(*[c.asc_nulls_first() for c in order]))
    placed = named.withColumn("__stem", stem).select(*cols(columns), "__name", late.alias("__late"), (place == 1).alias("__begins"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: set[str] = set()
        following: dict[str, int] = {}
        for b in batches:
            finals = []
            for own, late, begins in zip(*(b.column(c).to_pylist() for c in ("__name", "__late", "__begins")), strict=True):
                if begins:
                    used, following = set(), {}
                final = own
                if own in used:
                    number = following.get(own, 1)
                    while f"{own}_{number}" in used:
                        number += 1
                    following[own] = number
                    final = None if late else f"{own}_{number}"
                if final is not None:
                    used.add(final)
                finals.append(final)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(columns))], pa.array(finals, pa.string())], names=[*columns, "final_name"])

    kept = placed.select(*cols(columns)).schema
    return placed.mapInArrow(fold, T.StructType([*kept.fields, T.StructField("final_name", T.StringType())]))


def _last_per_name(columns: DataFrame, name: Column) -> DataFrame:
    """One row per dataset and (rewritten) name; of several, the last by ordinal counts."""
    return columns.groupBy("dataset", name.alias("key")).agg(
        F.max_by(F.struct("ordinal", "name", "type"), "ordinal").alias("c")
    ).select("dataset", "key", "c.ordinal", "c.name", "c.type")


def schema_join(left: DataFrame, right: DataFrame, transform: bool = False) -> DataFrame:
    """Columns of both sides by name: ``common``, ``missing`` (left only) or ``extra``."""
    name = transform_name(F.col("name")) if transform else F.col("name")
    lhs = _last_per_name(left, name).select("dataset", F.col("key").alias("name"), F.col("type").alias("left_type"))
    rhs = _last_per_name(right, name).select("dataset", F.col("key").alias("name"), F.col("type").alias("right_type"))
    status = (
        F.when(F.col("right_type").isNull(), "missing").when(F.col("left_type").isNull(), "extra").otherwise("common")
    )
    return lhs.join(rhs, ["dataset", "name"], "full").withColumn("status", status)


def type_mismatches(left: DataFrame, right: DataFrame, transform: bool = False) -> DataFrame:
    """Common columns whose target type does not fit the logical type."""
    common = schema_join(left, right, transform).filter(F.col("status") == "common").drop("status")
    return common.filter(~types_compatible(F.col("left_type"), F.col("right_type")))


def type_mismatches_exact(left: DataFrame, right: DataFrame) -> DataFrame:
    """Common columns whose type names differ at all."""
    common = schema_join(left, right).filter(F.col("status") == "common").drop("status")
    return common.filter(F.col("left_type") != F.col("right_type"))


def schema_summary(left: DataFrame, right: DataFrame, transform: bool = False) -> DataFrame:
    """Column counts and verdict per dataset."""
    joined = schema_join(left, right, transform)
    mismatch = (F.col("status") == "common") & ~types_compatible(F.col("left_type"), F.col("right_type"))
    return joined.groupBy("dataset").agg(
        F.count("left_type").alias("left_columns"),
        F.count("right_type").alias("right_columns"),
        F.count_if(F.col("status") == "common").alias("common_columns"),
        F.count_if(F.col("status") == "missing").alias("missing_columns"),
        F.count_if(F.col("status") == "extra").alias("extra_columns"),
        F.count_if(mismatch).alias("type_mismatches"),
    ).withColumn(
        "schema_match",
        (F.col("missing_columns") == 0) & (F.col("extra_columns") == 0) & (F.col("type_mismatches") == 0),
    )


def column_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column names left minus right, right minus left and in both, tagged by ``part``."""
    sides = left.select("dataset", "name", F.lit(1).alias("side")).unionByName(
        right.select("dataset", "name", F.lit(2).alias("side"))
    )
    part = F.when(F.min("side") == 2, "right_only").when(F.max("side") == 1, "left_only").otherwise("both")
    return sides.groupBy("dataset", "name").agg(part.alias("part"))


def combine_schemas(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left columns, then the right columns whose name is new, in order.

    Ordinals of the added columns continue after the left ones; of repeated new names the
    first counts.
    """
    new = (
        right.join(left.select("dataset", "name"), ["dataset", "name"], "left_anti")
        .groupBy("dataset", "name").agg(F.min_by(F.struct("ordinal", "type"), "ordinal").alias("c"))
        .select("dataset", "c.ordinal", "name", "c.type")
    )
    new = number_within(new, ["dataset"], ["ordinal"], "__k")
    last = left.groupBy("dataset").agg(F.max("ordinal").alias("__last"))
    added = new.join(last, "dataset", "left").select(
        "dataset", (F.coalesce("__last", F.lit(0)) + F.col("__k")).alias("ordinal"), "name", "type"
    )
    return left.select("dataset", F.col("ordinal").cast("bigint"), "name", "type").unionByName(added)


def concat_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows of the batches, repeats kept; columns a batch lacks are NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def match_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Target columns matched to source columns by letters and digits only.

    ``status``: ``matched``; ``left_only`` / ``right_only`` for columns one side lacks;
    ``default_type`` for all columns of a dataset with no source columns; and
    ``target_missing`` for all columns of a dataset that has no target.
    """
    lhs = _last_per_name(left, match_key(F.col("name"))).select(
        "dataset", "key", F.col("name").alias("left_name"), F.col("type").alias("left_type")
    )
    rhs = right.select(
        "dataset", match_key(F.col("name")).alias("key"), F.col("name").alias("right_name"),
        F.col("type").alias("right_type"),
    )
    present = (
        left.groupBy("dataset").agg(F.lit(True).alias("has_left"))
        .join(right.groupBy("dataset").agg(F.lit(True).alias("has_right")), "dataset", "full")
    )
    joined = lhs.join(rhs, ["dataset", "key"], "full").join(present, "dataset")
    has_left, has_right = F.col("left_name").isNotNull(), F.col("right_name").isNotNull()
    status = (
        F.when(F.col("has_right").isNull(), "target_missing")
        .when(F.col("has_left").isNull(), "default_type")
        .when(has_left & has_right, "matched").when(has_left, "left_only").otherwise("right_only")
    )
    return joined.select(
        "dataset",
        F.coalesce("right_name", "left_name").alias("name"),
        F.when(has_left, cast_type(F.col("left_type"))).otherwise(F.lower("right_type")).alias("data_type"),
        F.coalesce("left_type", F.lit("UNKNOWN")).alias("left_type"),
        F.when(has_left, F.col("left_name"))
        .when(F.col("has_left").isNull(), F.col("right_name"))
        .otherwise(F.concat(F.lit("MISSING_IN_LEFT_"), "right_name")).alias("left_name"),
        status.alias("status"),
    )


def profiled_columns(df: DataFrame, dataset: str) -> DataFrame:
    """Column table of one DataFrame with its row and non-NULL counts, in one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("name"),
            F.lit(logical_type(f.dataType)).alias("type"), F.col(f"n_{i}").alias("values"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.lit(dataset).alias("dataset"), "rows", F.inline(F.array(*entries)))
