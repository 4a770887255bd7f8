"""A splitting reader for CSV files whose quoted values hold line breaks.

Spark's text source reads the lines of a file by byte ranges. A line break may stand in a quoted value, so whether a range begins inside
one is not known where it is read. Every range therefore reports what it does under both assumptions (one small row for a range), a
pass over those rows in file order picks the true one, and a second pass joins the lines to records. A record that goes on in the next
ranges is put together from its pieces.

Quotes follow the CSV reader: one opens a value only at its beginning, ``""`` stands for a quote, and whatever follows a closing quote
belongs to the value up to the next separator. A quote that is never closed takes the rest of the file, as there, but for its last line break.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrytally.session import materialise

# Python workers get this module's functions with the job, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Encodings in which a byte of a separator, a quote or a line break is never part of another character, and which Spark decodes.
ENCODINGS = ("utf-8", "US-ASCII", "ISO-8859-1")
_KIND = "file string, origin bigint, start bigint, first boolean, whole boolean, text binary"
_BOM = b"\xef\xbb\xbf"


class _Quotes:
    """Follows quoted values from line to line."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        text = rb'[^"]*+(?:""[^"]*+)*+'
        # Whole values up to the last one, which opens a quote and does not close it.
        self.opens = re.compile(rb'(?:(?:"' + text + rb'"[^' + s + rb']*+|(?!")[^' + s + rb']*+)' + s + rb')*+"' + text, re.S)
        self.rest = re.compile(text + rb'(?:"[^' + s + rb']*+(?:' + s + rb')?)?', re.S)
        self.stays = re.compile(text, re.S)

    def after(self, line: bytes, inside: bool) -> bool:
        """Whether the break behind a line stands inside a quoted value."""
        if b'"' not in line:
            return inside
        if inside:
            if self.stays.fullmatch(line):
                return True
            line = line[self.rest.match(line).end():]
        return self.opens.fullmatch(line) is not None


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes]]]:
    """Runs of lines of one byte range."""
    for b in batches:
        files, starts, texts = (b.column(c).to_pylist() for c in ("file", "start", "text"))
        lo = 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or (files[i], starts[i]) != (files[lo], starts[lo]):
                yield (files[lo], starts[lo]), texts[lo:i]
                lo = i


def csv_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame | None:
    """Rows (text and the path's partition columns): every record but the header of each file, with its line breaks.

    None if lines end in a bare carriage return, which the text source does not break at.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    parts = [c for c in lines.columns if c != "value"]
    # Both passes must see the same ranges, whatever executors come and go in between.
    lines = materialise(lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("text"), *parts,
    ))
    quotes = _Quotes(sep)
    kind = pa.schema([("file", pa.string()), ("start", pa.int64()), ("inside0", pa.bool_()), ("inside1", pa.bool_()),
                      ("ends0", pa.bool_()), ("ends1", pa.bool_()), ("rows0", pa.bool_()), ("rows1", pa.bool_()), ("crlf", pa.bool_()), ("bare", pa.bool_())])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for key, texts in _ranges(batches):
            if key not in found:
                found[key] = [[False, True], [False, False], [False, False], texts[0].endswith(b"\r"), False]
                if key[1] == 0:
                    texts[0] = texts[0].removeprefix(_BOM)
            # For a range that begins outside (0) or inside (1) a value: where it stands, whether it stood between records at the end of a
            # line, and whether a record that is not empty ended there.
            state = found[key]
            inside, ends, rows, _, _ = state
            for text in texts:
                quoted, filled = b'"' in text, text not in (b"", b"\r")
                after = (quotes.after(text, False), quotes.after(text, True)) if quoted else (False, True)
                for h in (0, 1):
                    was, inside[h] = inside[h], after[inside[h]]
                    if not inside[h]:
                        ends[h] = True
                        rows[h] |= was or filled
                state[4] |= b"\r" in text[:-1]
        for key, state in found.items():
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (*key, *state[0], *state[1], *state[2], *state[3:])))], schema=kind)

    flags = ", ".join(f"{f.name} boolean" for f in list(kind)[2:])
    rows = lines.select("file", "start", "text").mapInArrow(report, f"file string, start bigint, {flags}").collect()
    if any(r["bare"] for r in rows):
        return None
    # By range: whether it begins inside a value, the range that record began in, whether the header is still to come, how lines end.
    begins: dict[tuple[str, int], tuple[bool, int, bool, bool]] = {}
    file = None
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, inside, origin, first, crlf = r["file"], False, r["start"], True, r["crlf"]
        origin = origin if inside else r["start"]
        begins[file, r["start"]] = (inside, origin, first, crlf)
        began = int(inside)
        first = first and not r[f"rows{began}"]
        origin = r["start"] if r[f"ends{began}"] else origin
        inside = r[f"inside{began}"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for key, texts in _ranges(batches):
            if reader is None or reader.key != key:
                if reader is not None:
                    yield _batch(reader.rest())
                reader = _Reader(key, begins[key], quotes)
            yield _batch(list(reader.records(texts)))
        if reader is not None:
            yield _batch(reader.rest())

    pieces = materialise(lines.select("file", "start", "text").mapInArrow(cut, _KIND))
    whole = pieces.filter("whole and not first").select("file", "text")
    # A record is one row in the end, so its pieces may meet.
    joined = pieces.filter("not whole").groupBy("file", "origin").agg(
        F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts")
    ).filter("not first").select("file", F.aggregate(
        F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.col("parts")[0]["text"],
        lambda text, part: F.concat(text, F.lit(b"\n"), part["text"]),
    ).alias("text"))
    records = whole.unionByName(joined)
    if not parts:
        return records.select("text")
    # One row for each file.
    of_file = lines.groupBy("file").agg(*[F.first(c).alias(c) for c in parts])
    return records.join(of_file, "file").select("text", *parts)


class _Reader:
    """Joins the lines of one range, which it gets in parts, to records."""

    def __init__(self, key: tuple[str, int], begins: tuple[bool, int, bool, bool], quotes: _Quotes):
        self.key, self.quotes = key, quotes
        self.inside, self.origin, self.first, self.crlf = begins
        self.held: list[bytes] = []
        # A record that is under way when the range begins is a piece.
        self.whole = not self.inside
        self.opening = not self.inside and key[1] == 0

    def records(self, texts: list[bytes]) -> Iterator[tuple]:
        for text in texts:
            if self.opening:
                text, self.opening = text.removeprefix(_BOM), False
            # Where lines end in both characters, the CSV reader gives one for them, in values too.
            self.held.append(text.removesuffix(b"\r") if self.crlf else text)
            self.inside = self.quotes.after(text, self.inside)
            if not self.inside:
                yield from self._record(self.whole)
                self.held, self.whole, self.origin = [], True, self.key[1]

    def _record(self, whole: bool) -> Iterator[tuple]:
        text = b"\n".join(self.held)
        if whole and not text:
            return  # the CSV reader passes over empty lines
        yield (self.key[0], self.origin, self.key[1], self.first, whole, text)
        self.first = False

    def rest(self) -> list[tuple]:
        """What is under way when the range ends; its end is in another, or missing."""
        return list(self._record(False)) if self.held else []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
    columns = zip(*rows) if rows else ([],) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "origin", "start", "first", "whole", "text"]
    )
