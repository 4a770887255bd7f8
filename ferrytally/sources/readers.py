"""Scans: datasets, CSV files, control tables, lineage exports, stage listings."""

from __future__ import annotations

import codecs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols
from ferrytally.operators.counts import row_count
from ferrytally.operators.lineage import LINEAGE_SCHEMA
from ferrytally.operators.numbering import first_rows
from ferrytally.sources.csv_split import ENCODINGS, csv_records
from ferrytally.sources.json_split import object_members
from ferrytally.sources.replace import recover

CORRUPT = "_corrupt_record"
# Files beyond this size are worth more than one task.
SPLIT_BYTES = 128 << 20


def is_path(ref: str) -> bool:
    return "/" in ref


def read_ref(spark: SparkSession, ref: str) -> DataFrame:
    """A parquet path or a catalog table."""
    recover(spark, ref)
    return spark.read.parquet(ref) if is_path(ref) else spark.table(ref)


def read_dataset(
    source: DataFrame, query: str | None = None, limit: int | None = None, order: list[str] | None = None
) -> DataFrame:
    """A dataset, a SQL query over it as ``{table}``, or its first ``limit`` rows in ``order``.

    The query text names the dataset ``{table}``; Spark binds it to the DataFrame.
    """
    df = source if query is None else source.sparkSession.sql(query, table=source)
    if limit is None:
        return df
    return first_rows(df, cols(order or df.columns), limit, nulls_last=True)


def charset(encoding: str) -> str:
    """Spark's name of an encoding given in any usual spelling."""
    name = codecs.lookup(encoding).name
    return {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII"}.get(name, name)


def read_csv(
    spark: SparkSession, path: str, encoding: str = "utf-8", sep: str = ",", infer: bool = True,
    schema: T.StructType | str | None = None, multi_line: bool = False, split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """CSV with a header; types inferred, declared, or all text.

    Spark splits large files. ``multi_line`` keeps quoted line breaks inside a value; files are then split too if one is larger than
    ``split_bytes``. A task takes a whole file, whatever its size, in encodings that are not supersets of ASCII, with a separator of
    several characters, with lines that end in a bare carriage return and where the schema asks for corrupt records.
    """
    options = {
        "encoding": charset(encoding), "sep": sep, "quote": '"', "escape": '"', "multiLine": str(multi_line).lower(), "preferDate": "false",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    }
    reader = spark.read.options(**options).option("header", True)
    if multi_line and options["encoding"] in ENCODINGS and len(sep) == 1 and sep.isascii():
        # Without inference only the first header is read.
        named = (reader.schema(schema) if schema is not None else reader.option("inferSchema", False)).csv(path).schema
        if CORRUPT not in named.names and _largest_file(spark, path) > split_bytes:
            split = _split_csv(spark, path, options, named, infer and schema is None)
            if split is not None:
                return split
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; no content is read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def _split_csv(spark: SparkSession, path: str, options: dict[str, str], named: T.StructType, infer: bool) -> DataFrame | None:
    records = csv_records(spark, path, options["sep"])
    if records is None:
        return None
    parts = [c for c in records.columns if c != "text"]
    names = [c for c in named.names if c not in parts]
    # A cast leaves bytes that are no UTF-8 to the CSV parser, as in an ordinary scan.
    text = col("text").cast("string") if options["encoding"] == "utf-8" else F.decode("text", options["encoding"])
    texts = records.withColumn("text", text)
    kinds = [named[c].dataType for c in names]
    if infer:
        # Empty cells first: they set the number of columns and are of every type.
        cells = spark.createDataFrame([(options["sep"].join(['""'] * len(names)),)], "text string")
        typed = spark.read.options(**options).option("inferSchema", True).csv(cells.unionByName(texts.select("text")).rdd.map(lambda r: r[0]))
        kinds = [f.dataType for f in typed.schema]
    declared = ", ".join(f"c{i} {k.simpleString()}" for i, k in enumerate(kinds))
    parsed = texts.select(F.from_csv("text", declared, options).alias("row"), *parts)
    return parsed.select("row.*", *parts).toDF(*names, *parts)


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Control sheet: the first row is the header and every cell is text."""
    return read_csv(spark, path, infer=False, multi_line=True)


def read_lineage(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Entities of lineage exports, one row per entity with its key.

    An export is one JSON object, however large: its byte ranges are read by tasks of their own. With ``multi_line=False``
    every line is an export.
    """
    if multi_line:
        members = object_members(spark, path, "entities")
        export = F.concat(F.lit('{"entities":{'), "text", F.lit("}}"))
        documents = members.select(F.from_json(export, LINEAGE_SCHEMA).alias("export")).select("export.entities")
    else:
        documents = spark.read.schema(LINEAGE_SCHEMA).json(path)
    return documents.select(F.explode("entities").alias("entity_key", "entity")).select("entity_key", "entity.*")


def list_stage(spark: SparkSession, directory: str, pattern: str = "*.csv*") -> DataFrame:
    """Name, size and modification time of staged files; file content is not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .load(directory)
    )
    return files.select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def _text(name: str):
    stamp = F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(stamp, F.lit("")).alias(name)


def dataset_catalog(tables: dict[str, DataFrame], metadata: DataFrame | None = None) -> DataFrame:
    """Inventory of datasets with row and column counts.

    ``metadata(id, name, description, created, last_updated, owner)`` adds descriptions; missing
    values become empty text.
    """
    parts = [
        row_count(df).select(F.lit(i).alias("id"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"))
        for i, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    if metadata is None:
        metadata = counts.select("id", F.col("id").alias("name")).limit(0)
    texts = {c: F.lit(None).cast("string") for c in ("name", "description", "owner")}
    times = {c: F.lit(None).cast("timestamp_ntz") for c in ("created", "last_updated")}
    metadata = metadata.select("id", *[
        (col(c) if c in metadata.columns else missing).alias(c) for c, missing in {**texts, **times}.items()
    ])
    joined = counts.join(metadata, "id", "left")
    return joined.select(
        "id", F.coalesce("name", "id").alias("name"), F.coalesce("description", F.lit("")).alias("description"),
        _text("created"), _text("last_updated"), "row_count", "column_count",
        F.coalesce("owner", F.lit("")).alias("owner"),
    )


def dataflow_inventory(flows: DataFrame) -> DataFrame:
    """Dataflow listing with empty text for missing attributes."""
    columns = {"Dataflow ID": "id", "Name": "name", "Enabled": "enabled", "Draft": "draft", "NumOutputs": "num_outputs"}
    return flows.select(*[
        (F.coalesce(col(c).cast("string"), F.lit("")) if c in flows.columns else F.lit("")).alias(title)
        for title, c in columns.items()
    ])
