"""Running numbers and sums over a sorted table, whatever the size of its groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import stored
from ferrytally.session import materialise, shuffle_width

ROWS = 500_000  # rows of a partition, about


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy() for n in names], axis=1) if names else np.empty((batch.num_rows, 0), np.int64)


def _starts(groups: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """Where a group begins; the first row goes on with the group ``last``."""
    new = np.ones(len(groups), bool)
    new[1:] = (groups[1:] != groups[:-1]).any(axis=1)
    new[0] = last is None or bool((groups[0] != last).any())
    return new


def scanned(df: DataFrame, group: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """``df`` sorted by ``group`` and ``order``, with running values.

    ``number`` counts all rows and ``place`` the rows of a group, from 1; ``before_x`` and ``upto_x`` are the sums of ``x`` over the
    earlier rows of the group, without and with the row, modulo 2^64. ``group`` and ``sums`` are bigint columns without null.

    The rows are dealt into ranges, so that a group of any size is spread over many tasks. Tasks first report what each range
    ends with (one row per range, at most 20,000), and then go over their range with what the earlier ones carry into it.
    """
    df = stored(df)
    width = shuffle_width(df, df.count(), ROWS)
    # Without keys there is nothing to sort by.
    keys = [*group, *order]
    ranges = materialise(
        df.repartitionByRange(width, *keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id())
    )

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, first, last, whole, place = 0, None, None, True, 0
        total = np.zeros(len(sums), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            groups, values = _matrix(b, group), _matrix(b, sums)
            part, first = b.column("__part")[0].as_py(), groups[0] if first is None else first
            new = np.flatnonzero(_starts(groups, last))
            if len(new):
                whole = whole and last is None and len(new) == 1
                place, total = b.num_rows - new[-1], values[new[-1]:].sum(axis=0)
            else:
                place, total = place + b.num_rows, total + values.sum(axis=0)
            rows, last = rows + b.num_rows, groups[-1]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (part, rows, int(place), whole)] + [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (first, last, total)],
                names=["part", "rows", "place", "whole", "first", "last", "total"],
            )

    kind = "part bigint, rows bigint, place bigint, whole boolean, first array<bigint>, last array<bigint>, total array<bigint>"
    carried: dict[int, tuple] = {}
    number, last, place, total = 0, None, 0, np.zeros(len(sums), np.int64)
    for r in sorted(ranges.mapInArrow(ends, kind).collect()):
        carried[r["part"]] = number, last, place, total
        own = np.array(r["total"], np.int64)
        goes_on = r["whole"] and last is not None and list(last) == list(r["first"])
        number, last = number + r["rows"], np.array(r["last"], np.int64)
        place, total = (place + r["place"], total + own) if goes_on else (r["place"], own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            if not b.num_rows:
                continue
            number, last, place, total = state or carried[b.column("__part")[0].as_py()]
            groups, values = _matrix(b, group), _matrix(b, sums)
            new = _starts(groups, last)
            segment = np.cumsum(new)
            at = np.flatnonzero(new)
            rows = np.arange(1, b.num_rows + 1)
            places = rows - np.concatenate([[-place], at])[segment]
            added = np.cumsum(values, axis=0)
            upto = added - np.concatenate([-total[None], added[at] - values[at]])[segment]
            state = number + b.num_rows, groups[-1], places[-1], upto[-1]
            kept = [n for n in b.schema.names if n != "__part"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in kept], pa.array(number + rows), pa.array(places)]
                + [pa.array(np.ascontiguousarray((upto - values)[:, i])) for i in range(len(sums))]
                + [pa.array(np.ascontiguousarray(upto[:, i])) for i in range(len(sums))],
                names=[*kept, "number", "place", *[f"before_{s}" for s in sums], *[f"upto_{s}" for s in sums]],
            )

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    new = ["number", "place", *[f"before_{s}" for s in sums], *[f"upto_{s}" for s in sums]]
    return ranges.mapInArrow(run, ", ".join([*own, *[f"{n} bigint" for n in new]]))
