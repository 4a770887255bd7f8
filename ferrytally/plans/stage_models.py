"""Staging models: matched columns of a source table, aliased and optionally cast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.columns import col
from ferrytally.functions.names import apply_to_header, source_identifier, stage_alias
from ferrytally.operators.control import unchecked
from ferrytally.operators.schema import match_columns

# Spark types of the staging cast types.
SPARK_CASTS = {
    "timestamp": "timestamp_ntz", "float": "double", "number": "bigint", "text": "string",
    "varchar(16777216)": "string",
}
MODELLED = ("matched", "default_type")


def stage_select(df: DataFrame, columns: list[tuple[str, str]], use_cast: bool = False) -> DataFrame:
    """Project ``(name, cast type)`` columns under their staging alias; other columns are left out.

    Names are matched exactly; a value that does not fit its cast type becomes NULL.
    """
    names = [n for n, _ in columns if n in df.columns]
    types = dict(columns)
    aliases = apply_to_header(df.sparkSession, names, stage_alias)
    out = []
    for name, alias in zip(names, aliases, strict=True):
        value = col(name).try_cast(SPARK_CASTS.get(types[name], types[name])) if use_cast else col(name)
        out.append(value.alias(alias))
    return df.select(*out)


@dataclass(frozen=True)
class StageModels:
    """Columns of all models, and the control table with finished rows checked."""

    columns: DataFrame
    control: DataFrame


def stage_models(
    control: DataFrame, left_columns: DataFrame, right_columns: DataFrame, use_cast: bool = False
) -> StageModels:
    """Build the staging models of all unchecked control rows in one job.

    ``control(Check, Dataset ID, Name, Model)`` ties a source dataset to a target table; the column
    tables are keyed by those two names. Each model column comes with its select expression;
    columns one side lacks are listed with their status and no expression.
    """
    todo = unchecked(control).filter(F.col("Name").isNotNull() & F.col("Model").isNotNull()).select(
        F.col("Dataset ID").alias("dataset_id"), F.col("Name").alias("table_name"), F.col("Model").alias("model")
    )
    left = todo.join(left_columns, F.col("dataset_id") == F.col("dataset")).select(
        F.col("model").alias("dataset"), "ordinal", "name", "type"
    )
    right = todo.join(right_columns, F.col("table_name") == F.col("dataset")).select(
        F.col("model").alias("dataset"), "ordinal", "name", "type"
    )
    matched = match_columns(left, right).withColumn("alias", stage_alias(F.col("name")))
    quoted = F.concat(F.lit('"'), F.col("name"), F.lit('"'))
    value = F.concat(F.lit("cast("), quoted, F.lit(" as "), F.col("data_type"), F.lit(")")) if use_cast else quoted
    expression = F.when(
        F.col("status").isin(*MODELLED), F.concat(value, F.lit(" as "), F.col("alias"))
    )
    columns = matched.withColumn("expression", expression).withColumnRenamed("dataset", "model")
    finished = columns.filter(F.col("status").isin(*MODELLED)).select(F.col("model").alias("__model")).distinct()
    marked = control.join(finished, F.col("Model") == F.col("__model"), "left")
    checked = F.when(F.col("__model").isNotNull(), F.lit("True")).otherwise(F.col("Check"))
    return StageModels(columns, marked.withColumn("Check", checked).drop("__model"))


def source_manifest(control: DataFrame, database: str, schema: str) -> DataFrame:
    """Pending tables of a control table with their upper-case name and identifier."""
    rows = unchecked(control).filter(F.col("Name").isNotNull())
    return rows.select(
        F.lit(database).alias("database"), F.lit(schema).alias("schema"), F.upper("Name").alias("name"),
        source_identifier(F.col("Name")).alias("identifier"),
    )
