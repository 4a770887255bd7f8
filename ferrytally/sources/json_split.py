"""A splitting reader for exports that are one large JSON object.

The members of one object inside it (``{"entities": {"key": {...}, ...}}``) become rows, read by as many tasks as the file has byte ranges.

Files are cut at every ``}``, which Spark's text source does in parallel. A ``}`` may stand in a text value, so whether a range begins inside
one, and how deep, is not known where it is read. Every range therefore reports what it does under both assumptions (three numbers), and
those rows in file order tell the true one. Knowing how deep it begins, every range reports how many members it ends (two values), and a
third pass over the ranges cuts out the members. The driver holds these few numbers of each range and nothing that grows with what is in it.
A member that goes on in the next range is put together from its pieces.

A cut never falls inside an escape, as ``\\}`` is none in JSON.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ferrytally.session import materialise

# Python workers get this module's functions with the job, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTE, _ESCAPE, _OPEN, _CLOSE = 34, 92, 123, 125
MEMBERS = 2  # depth of the object whose members are wanted


def _marks(data: np.ndarray) -> np.ndarray:
    """Positions of the quotes that begin or end a text: those after an even number of backslashes."""
    quotes = np.flatnonzero(data == _QUOTE)
    escapes = np.flatnonzero(data == _ESCAPE)
    if not len(quotes) or not len(escapes):
        return quotes
    # For each backslash, how many there are in a row up to it.
    at = np.arange(len(escapes))
    first = np.maximum.accumulate(np.where(np.diff(escapes, prepend=-2) > 1, at, 0))
    run = at - first + 1
    before = np.searchsorted(escapes, quotes) - 1
    after = (before >= 0) & (escapes[before] == quotes - 1)
    return quotes[~(after & (run[before] % 2 == 1))]


def _braces(data: np.ndarray, quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of braces outside texts, and the change of depth after each, if the data begins inside a text or not."""
    at = np.flatnonzero((data == _OPEN) | (data == _CLOSE))
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    return at, np.cumsum(np.where(data[at] == _OPEN, 1, -1))


class _Turns:
    """What a range does to texts and, if it begins outside (0) or inside (1) one, to the depth."""

    def __init__(self):
        self.flips = 0
        self.depth = [0, 0]

    def add(self, data: np.ndarray, key: tuple[str, int]) -> None:
        quotes = _marks(data)
        for start in (0, 1):
            _, depth = _braces(data, quotes, self.flips ^ start)
            self.depth[start] += int(depth[-1]) if len(depth) else 0
        self.flips ^= len(quotes) % 2

    def row(self) -> tuple:
        return (self.flips, *self.depth)


class _Ends:
    """What a range that begins in a known state does to the members: how many it ends, and whether the last object that it opens at their
    place is the wanted one (None: it opens none)."""

    def __init__(self, begins: dict[tuple[str, int], _State], pattern: re.Pattern):
        self.begins, self.pattern = begins, pattern
        self.state, self.ends, self.named = None, 0, None

    def add(self, data: np.ndarray, key: tuple[str, int]) -> None:
        state = self.state or self.begins[key]
        quotes = _marks(data)
        at, depth = _braces(data, quotes, state.inside)
        depth = depth + state.depth
        closing = data[at] == _CLOSE
        self.ends += int(np.isin(depth[closing], (MEMBERS, MEMBERS - 1)).sum())
        opened = at[~closing & (depth == MEMBERS)]
        if len(opened):
            self.named = any(m.end() - 1 == opened[-1] for m in self.pattern.finditer(data))
        self.state = _State(state.inside ^ len(quotes) % 2, int(depth[-1]) if len(depth) else state.depth)

    def row(self) -> tuple:
        return (self.ends, self.named)


def _wanted(name: str) -> re.Pattern:
    return re.compile(rb'"' + re.escape(name.encode()) + rb'"\s*:\s*\{')


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """Runs of records of one byte range, as bytes with the ``}`` back in place."""
    for b in batches:
        files, starts, texts = (b.column(c).to_pylist() for c in ("file", "start", "text"))
        lo = 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or (files[i], starts[i]) != (files[lo], starts[lo]):
                yield (files[lo], starts[lo]), b"}".join(texts[lo:i]) + b"}"
                lo = i


class _State:
    """Where a range really begins."""

    def __init__(self, inside: int = 0, depth: int = 0, number: int = 0, named: bool = False):
        self.inside, self.depth, self.number, self.named = inside, depth, number, named

    def turned(self, row) -> _State:
        """Where the next range begins: in a text or not, and how deep."""
        return _State(self.inside ^ row["flips"], self.depth + row[f"depth{self.inside}"])

    def counted(self, row) -> tuple[int, bool]:
        """The number of members ended so far, and whether the object is the wanted one, behind a range."""
        return self.number + row["ends"], self.named if row["named"] is None else row["named"]


def object_members(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows (file, text): the members of the object ``name`` of each export, a few members or one in each text, without the braces around them.

    The members are objects, or values that are not made of objects. The export may hold other members and be written over any number of
    lines; a file may hold several exports.
    """
    records = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("text")
    )
    # All passes must see the same ranges, whatever executors come and go in between.
    records = materialise(records)
    pattern = _wanted(name)

    def reported(make: Callable, kind: pa.Schema, schema: str) -> list[Row]:
        """What each range does, in file order: a row of a few numbers for a range, whatever is in it."""
        def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[str, int], object] = {}
            for key, data in _ranges(batches):
                if key not in found:
                    found[key] = make()
                found[key].add(np.frombuffer(data, np.uint8), key)
            for (file, start), summary in found.items():
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (file, start, *summary.row())))], schema=kind)

        return sorted(records.mapInArrow(report, schema).collect(), key=lambda r: (r["file"], r["start"]))

    place = [("file", pa.string()), ("start", pa.int64())]
    turns = pa.schema([*place, ("flips", pa.int64()), ("depth0", pa.int64()), ("depth1", pa.int64())])
    begins: dict[tuple[str, int], _State] = {}
    state, file = _State(), None
    for row in reported(_Turns, turns, "file string, start bigint, flips bigint, depth0 bigint, depth1 bigint"):
        state, file = (state if row["file"] == file else _State()), row["file"]
        begins[file, row["start"]] = state
        state = state.turned(row)
    # Which braces stand at the members' place is known only now: counted for every depth at once, a range might report as many as it has braces.
    ends = pa.schema([*place, ("ends", pa.int64()), ("named", pa.bool_())])
    file = None
    for row in reported(lambda: _Ends(begins, pattern), ends, "file string, start bigint, ends bigint, named boolean"):
        (number, named), file = ((number, named) if row["file"] == file else (0, False)), row["file"]
        state = begins[file, row["start"]]
        state.number, state.named = number, named
        number, named = state.counted(row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for key, data in _ranges(batches):
            if reader is None or reader.key != key:
                if reader is not None:
                    yield reader.batch([reader.rest()])
                reader = _Reader(key, begins[key], pattern)
            yield reader.batch(list(reader.members(data)))
        if reader is not None:
            yield reader.batch([reader.rest()])

    pieces = records.mapInArrow(cut, "file string, number bigint, start bigint, whole boolean, text binary")
    pieces = materialise(pieces.filter(F.length("text") > 0))
    whole = pieces.filter("whole").select("file", F.col("text").cast("string").alias("text"))
    # A member is one row in the end, so its pieces may meet.
    parts = pieces.filter("not whole").groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda text, part: F.concat(text, part["text"])).cast("string")
    return whole.unionByName(parts.select("file", F.regexp_replace(joined, r"^[,\s]+|[,\s]+$", "").alias("text")).filter("text <> ''"))


class _Reader:
    """Cuts the members out of one range, which it gets in parts."""

    def __init__(self, key: tuple[str, int], state: _State, pattern: re.Pattern):
        self.key, self.pattern = key, pattern
        self.inside, self.depth, self.number, self.named = state.inside, state.depth, state.number, state.named
        self.held: list[bytes] = []
        # A member that is under way when the range begins is a piece.
        self.first = self._within()

    def _within(self) -> bool:
        return self.named and self.depth >= MEMBERS

    def members(self, data: bytes) -> Iterator[tuple]:
        raw = np.frombuffer(data, np.uint8)
        quotes = _marks(raw)
        at, depth = _braces(raw, quotes, self.inside)
        wanted = {m.end() - 1 for m in self.pattern.finditer(data)}
        before = np.concatenate([[0], depth[:-1]]) + self.depth
        depth = depth + self.depth
        # Only where the object opens, a member ends, or the object ends.
        edge = (np.minimum(before, depth) == MEMBERS - 1) | ((depth == MEMBERS) & (before == MEMBERS + 1))
        begin = 0
        for position, was, now in zip(at[edge].tolist(), before[edge].tolist(), depth[edge].tolist()):
            if now > was:
                self.named, self.held, self.first = position in wanted, [], False
                begin = position + 1
                continue
            if self.named:
                # The closing brace of the object itself belongs to no member.
                yield self._piece(data[begin:position + (now == MEMBERS)], not self.first)
            self.number, self.held, self.first, begin = self.number + 1, [], False, position + 1
        self.inside ^= len(quotes) % 2
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if self._within():
            self.held.append(data[begin:])

    def _piece(self, text: bytes, whole: bool) -> tuple:
        text = b"".join([*self.held, text])
        if whole:
            text = text.strip(b", \t\r\n")
        return (self.key[0], self.number, self.key[1], whole, text)

    def rest(self) -> tuple:
        """What is under way when the range ends; its end is in another."""
        return self._piece(b"", False) if self._within() else (*self.key[:1], self.number, self.key[1], False, b"")

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        columns = zip(*rows) if rows else ([],) * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "number", "start", "whole", "text"])
