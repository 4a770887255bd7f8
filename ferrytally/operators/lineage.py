"""Lineage over tables: edges, producers, consumers, transitive sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.columns import col, cols
from ferrytally.functions.cells import LIST_SEPARATOR, clean_ids, split_ids
from ferrytally.operators.closure import closed_parts, labelled, split_parts
from ferrytally.operators.numbering import HOT_ROWS, hot_keys, number_within, profile_keys, split_hot
from ferrytally.session import materialise, stored

_REF = "array<struct<id:string,type:string>>"
LINEAGE_SCHEMA = f"entities map<string, struct<id:string,type:string,parents:{_REF},children:{_REF}>>"


def _ids(refs: Column, kind: str) -> Column:
    """Ids of the references of one kind; missing reference lists are empty."""
    of_kind = F.filter(F.coalesce(refs, F.array().cast(_REF)), lambda r: (r["type"] == kind) & r["id"].isNotNull())
    return F.transform(of_kind, lambda r: r["id"])


def lineage_edges(entities: DataFrame) -> DataFrame:
    """``(flow_id, role, dataset_id)`` of every dataflow: its ``source`` and ``output`` datasets."""
    flows = entities.filter(F.col("type") == "DATAFLOW")
    ends = F.array(
        F.struct(F.lit("source").alias("role"), _ids(F.col("parents"), "DATA_SOURCE").alias("ids")),
        F.struct(F.lit("output").alias("role"), _ids(F.col("children"), "DATA_SOURCE").alias("ids")),
    )
    return (
        flows.select(F.col("id").alias("flow_id"), F.inline(ends))
        .select("flow_id", "role", F.explode("ids").alias("dataset_id"))
    )


# A list cell holds at most this many ids; a longer list goes on in the next part.
CELL_IDS = 10_000


def list_cells(
    ids: DataFrame, by: str, kinds: dict[str, str], separator: str = LIST_SEPARATOR, cell_ids: int = CELL_IDS
) -> DataFrame:
    """Sorted list cells from distinct ``(by, kind, id)`` rows: one row per ``by`` and ``part``.

    ``kinds`` maps a kind to its output column. Nearly every list fits part 0. A list of any length
    is cut into parts of ``cell_ids``, so no task ever holds more than that of one list.
    """
    ids = materialise(ids)  # measured, then used: not to be computed twice
    part = F.lit(0).cast("bigint")
    if profile_keys([ids], [by, "kind"]).largest > cell_ids:
        # Rows without an id only keep their list present; they take no place in it.
        listed = number_within(ids.filter(F.col("id").isNotNull()), [by, "kind"], ["id"], "__k")
        ids = listed.unionByName(ids.filter(F.col("id").isNull()).withColumn("__k", F.lit(1).cast("bigint")))
        part = F.floor((F.col("__k") - 1) / cell_ids)
    cells = [
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("id")))), separator).alias(name)
        for kind, name in kinds.items()
    ]
    return ids.withColumn("part", part).groupBy(by, "part").agg(*cells)


def merge_ids(df: DataFrame, by: str, names: list[str], cell_ids: int = CELL_IDS) -> DataFrame:
    """Per ``by``, the distinct sorted ids of list cells, as cells."""
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), split_ids(col(n)).alias("ids")) for n in names])
    distinct = (
        df.select(col(by).alias(by), F.inline(kinds)).select(by, "kind", F.explode_outer("ids").alias("id")).distinct()
    )
    return list_cells(distinct, by, {n: n for n in names}, cell_ids=cell_ids)


def producer_ids(entities: DataFrame, datasets: DataFrame) -> DataFrame:
    """``(flow_id, kind, id)``: dataflows that output one of ``datasets(dataset_id)``, a row per source and output."""
    flows = entities.filter(F.col("type") == "DATAFLOW")
    wanted = datasets.select(F.col("dataset_id").alias("__wanted")).distinct()
    producing = (
        flows.select(F.col("id").alias("__flow"), F.explode(_ids(F.col("children"), "DATA_SOURCE")).alias("__output"))
        .join(wanted, F.col("__output") == F.col("__wanted"), "left_semi").select("__flow").distinct()
    )
    touched = lineage_edges(flows.join(producing, F.col("id") == F.col("__flow"), "left_semi")).distinct()
    return touched.select("flow_id", F.col("role").alias("kind"), F.col("dataset_id").alias("id"))


def producers_of(entities: DataFrame, datasets: DataFrame) -> DataFrame:
    """``producer_ids`` as text: the ids of a dataflow in list cells."""
    return list_cells(producer_ids(entities, datasets), "flow_id", {"source": "source_ids", "output": "output_ids"})


def consumers_of(entities: DataFrame, datasets: DataFrame) -> DataFrame:
    """``(dataset_id, flow_id)`` pairs: dataflows that read a dataset.

    A dataset with an entity of its own lists its consumers as children; for the others the
    dataflows naming it as a parent are looked up.
    """
    wanted = datasets.select("dataset_id").distinct()
    own = entities.select("entity_key", "children")
    keyed = wanted.withColumn("__key", F.concat(F.lit("DATA_SOURCE"), "dataset_id"))
    direct = (
        keyed.join(own, F.col("__key") == F.col("entity_key"))
        .select("dataset_id", F.explode(_ids(F.col("children"), "DATAFLOW")).alias("flow_id"))
        .filter(F.col("flow_id") != "")
    )
    unknown = keyed.join(own.select("entity_key"), F.col("__key") == F.col("entity_key"), "left_anti").drop("__key")
    readers = (
        lineage_edges(entities).filter((F.col("role") == "source") & (F.col("flow_id") != ""))
        .select("flow_id", F.col("dataset_id").alias("__read"))
    )
    scanned = unknown.join(readers, F.col("dataset_id") == F.col("__read")).select("dataset_id", "flow_id")
    return direct.unionByName(scanned).distinct()


def lineage_report(required: DataFrame, consumers: DataFrame) -> DataFrame:
    """Per required dataset its consumers as text (``None`` without any) and their number.

    A list too long for one cell continues in further rows with the next ``part``.
    """
    distinct = consumers.select("dataset_id", F.col("flow_id").alias("id")).distinct()
    counts = distinct.groupBy(F.col("dataset_id").alias("__id")).agg(F.count("id").alias("n"))
    cells = list_cells(distinct.withColumn("kind", F.lit("flow")), "dataset_id", {"flow": "flows"}, ", ")
    listed = cells.withColumnRenamed("dataset_id", "__cell_id")
    joined = (
        required.join(counts, F.col("dataset_id") == F.col("__id"), "left")
        .join(listed, F.col("dataset_id") == F.col("__cell_id"), "left")
    )
    return joined.select(
        *cols(required.columns), F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("flows", F.lit("None")).alias("flow_ids"), F.coalesce("n", F.lit(0)).cast("bigint").alias("flow_count"),
    )


def lineage_summary(report: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("flow_count"), F.lit(0))
    return report.filter(F.col("part") == 0).agg(
        F.count(F.lit(1)).alias("datasets"), F.count_if(F.col("flow_count") > 0).alias("datasets_with_flows"),
        total.alias("flow_ids"), F.coalesce(F.try_divide(total, F.count(F.lit(1))), F.lit(0.0)).alias("mean_flows"),
    )


def explode_outputs(flows: DataFrame) -> DataFrame:
    """One row per output id; flows without outputs keep a row with empty text."""
    outputs = F.array_distinct(split_ids(F.col("output_ids")))
    return flows.select(
        "flow_id", clean_ids(F.col("source_ids")).alias("source_ids"), F.explode_outer(outputs).alias("output_id")
    ).withColumn("output_id", F.coalesce("output_id", F.lit("")))


def source_map(flows: DataFrame) -> DataFrame:
    """Distinct ``(output_id, source_id)`` pairs; an output of several flows unites their sources."""
    outputs = flows.select("source_ids", F.explode(split_ids(F.col("output_ids"))).alias("output_id"))
    return outputs.select("output_id", F.explode(split_ids(F.col("source_ids"))).alias("source_id")).distinct()


def expansion_stats(flows: DataFrame) -> DataFrame:
    """Size of the flow table before and after ``explode_outputs``."""
    after = explode_outputs(flows)
    sources = flows.select(F.explode(split_ids(F.col("source_ids"))).alias("source_id")).distinct()
    parts = flows.agg(F.count(F.lit(1)).alias("rows_before")).unionByName(
        after.agg(
            F.count(F.lit(1)).alias("rows_after"), F.countDistinct("flow_id").alias("unique_flows"),
            F.countDistinct("output_id").alias("unique_outputs"),
        ), allowMissingColumns=True,
    ).unionByName(sources.agg(F.count(F.lit(1)).alias("unique_sources")), allowMissingColumns=True)
    one = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    ratio = F.coalesce(F.try_divide(F.col("rows_after"), F.col("rows_before")), F.lit(0.0))
    return one.withColumn("ratio", ratio)


# Parts that the rows of a hub are dealt into.
HUB_PARTS = 64


def _extended(pairs: DataFrame, near: DataFrame, size: int, hot_rows: int) -> DataFrame:
    """``pairs`` followed by ``near``. Pairs that end in a hub are dealt into parts, each with what is near the hub."""
    step = near.select(F.col("output_id").alias("__via"), F.col("source_id").alias("__next"), F.col("hops").alias("__more"))

    def joined(pairs: DataFrame, steps: DataFrame, *more: Column) -> DataFrame:
        on = reduce(lambda a, b: a & b, more, F.col("source_id") == F.col("__via"))
        # Pairs repeat their ids, so their files are small beside their rows: never broadcast.
        return pairs.join(steps.hint("merge"), on).select(
            "output_id", F.col("__next").alias("source_id"), (F.col("hops") + F.col("__more")).alias("hops")
        )

    profile = profile_keys([pairs], ["source_id"], hot_rows) if size > hot_rows else None
    if profile is None or profile.hot_keys == 0:
        return joined(pairs, step)
    hot = hot_keys([pairs], ["source_id"], hot_rows)
    cold_part, hub_part = split_hot(pairs, hot, ["source_id"], profile.hot_keys)
    hubs = step.join(hot.select("__k0"), F.col("__via") == F.col("__k0"), "left_semi")
    hubs = hubs.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(HUB_PARTS - 1))))
    dealt = hub_part.withColumn("__own", F.pmod(F.xxhash64("output_id"), F.lit(HUB_PARTS)).cast("int"))
    return joined(cold_part, step).unionByName(joined(dealt, hubs, F.col("__own") == F.col("__part")))


# A connected part of up to this many edges is closed by one task.
PART_EDGES = 20_000


def transitive_sources(
    edges: DataFrame, max_hops: int | None = None, hot_rows: int = HOT_ROWS, part_edges: int = PART_EDGES
) -> DataFrame:
    """All ``(output_id, source_id)`` pairs reachable over ``edges``, in at most ``max_hops`` steps; cycles are safe.

    Edges are split into connected parts first. Parts of up to ``part_edges`` edges (and ``hot_rows``) are closed by one task each, and their
    pairs are made as they are used: only edges are stored. Larger parts are closed by joins (``_joined_sources``), whose pairs are stored.
    """
    if edges.schema["output_id"].dataType != edges.schema["source_id"].dataType:
        return _joined_sources(edges, max_hops, hot_rows)
    small, others, total = split_parts(labelled(edges.select("output_id", "source_id")), min(part_edges, hot_rows))
    pairs = closed_parts(small, total, max_hops)
    return pairs if others is None else pairs.unionByName(_joined_sources(others, max_hops, hot_rows))


def _joined_sources(edges: DataFrame, max_hops: int | None, hot_rows: int) -> DataFrame:
    """The same by joins, for parts of any size.

    The reach doubles in each round. With all pairs of distance up to ``span`` known, a pair farther apart by up to as
    much again has a node exactly ``span`` steps from its start, so one join of the pairs at that very distance with all known
    ones finds it, together with its distance. Rounds grow with the logarithm of the longest shortest path, and as
    shortest distances inside a cycle are short, cycles end it like anything else.

    The rounds are stored in the shared folder, so a lost executor re-reads a round instead of recomputing all of them.
    """
    near = stored(edges.select("output_id", "source_id", F.lit(1).cast("bigint").alias("hops")).distinct())
    farthest, span = near, 1
    size = near.count()
    while size and (max_hops is None or span < max_hops):
        reached = _extended(farthest, near, size, hot_rows).groupBy("output_id", "source_id").agg(F.min("hops").alias("hops"))
        known = near.select(F.col("output_id").alias("__o"), F.col("source_id").alias("__s")).hint("merge")
        fresh = stored(reached.join(
            known, (F.col("output_id") == F.col("__o")) & (F.col("source_id") == F.col("__s")), "left_anti"
        ))
        span *= 2
        near, farthest = near.unionByName(fresh), fresh.filter(F.col("hops") == span)
        size = farthest.count()
    found = near if max_hops is None else near.filter(F.col("hops") <= max_hops)
    return found.select("output_id", "source_id")


def source_cells(closure: DataFrame, cell_ids: int = CELL_IDS) -> DataFrame:
    """Transitive sources per output as sorted cells."""
    ids = closure.select("output_id", F.lit("source").alias("kind"), F.col("source_id").alias("id"))
    return list_cells(ids, "output_id", {"source": "all_source_ids"}, cell_ids=cell_ids)
